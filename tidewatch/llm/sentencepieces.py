"""SentencePiece encoding with byte offsets, and decoding, for BPE models with byte fallback.

The text is normalised by repeatedly taking the longest prefix that the model's compiled character map knows
and writing its replacement; for every byte written, the source byte it came from is recorded.  The pieces
cut the normalised text, so the record projects each of them to a span of the original bytes.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import kept_in_worker
from tidewatch.shipping import ship_by_value

ship_by_value(__name__)

# Fixed values of the format: the mark for a space, what stands for bytes that are no UTF-8, piece types.
SPACE = "▁"
NO_UTF8 = "�"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Words kept with their ids in each worker, twice as many at most beside those of one text, and the longest in characters.
# Workers stay when a task is over, so what they keep counts in every later stage: about 200 bytes a word.
MEMO_WORDS = 120_000
MEMO_CHARS = 64
# Texts whose ids are held at a time.
ROWS = 1000
SHORT = 32
NO_SCORE = float("-inf")


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and the replacements it points to."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = compiled[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """(length of the longest known prefix of text[at:], its replacement)."""
        units, found = self.units, None
        unit = units[0]
        node = (unit >> 10) << ((unit & (1 << 9)) >> 6)
        for i in range(at, len(text)):
            byte = text[i]
            node ^= byte
            unit = units[node]
            if unit & ((1 << 31) | 0xFF) != byte:
                break
            node ^= (unit >> 10) << ((unit & (1 << 9)) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                found = i + 1 - at, self.replacements[start : self.replacements.index(b"\0", start)]
        return found

    def apply(self, text: bytes) -> tuple[bytes, list[int]]:
        """The normalised bytes, and for each of them and for the end the source byte."""
        out, source, at = bytearray(), [], 0
        while at < len(text):
            found = self.longest(text, at)
            if found is None:
                lead = text[at]
                n = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                found = n, text[at : at + n]
            out += found[1]
            source += [at] * len(found[1])
            at += found[0]
        return bytes(out), [*source, len(text)]


class _Words(dict):
    """What is known of words; short ones are remembered, and forgotten when they are not met for a while."""

    def __init__(self, model):
        super().__init__()
        self.model, self.older = model, {}

    def __missing__(self, word: str):
        found = self.older.get(word)
        if found is None:
            found = self.model.known(word)
        if len(word) <= MEMO_CHARS:
            self[word] = found
        return found

    def age(self) -> None:
        """Keep the words met since the last time, as the older ones, if they are many."""
        if len(self) > MEMO_WORDS:
            self.older = dict(self)
            self.clear()


@dataclass
class Model:
    """What encoding needs of a model file."""

    pieces: list[str]
    types: list[int]
    rank: dict[str, float]
    ids: dict[str, int]
    byte_ids: dict[int, int]
    bos: int
    eos: int
    unk: int
    charmap: CharacterMap | None
    dummy_prefix: bool
    trim: bool
    escape: bool
    splits: bool
    letters_apart: bool
    memo: dict = field(default_factory=dict)

    def __post_init__(self):
        self.memo = _Words(self)

    @classmethod
    def read(cls, path: str) -> Model:
        with open(path, "rb") as file:
            return cls.parse(file.read())

    @classmethod
    def parse(cls, content: bytes) -> Model:
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(content)
        trainer, spec = proto.trainer_spec, proto.normalizer_spec
        if trainer.model_type != 2 or trainer.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with leading space marks are supported")
        pieces, types = [p.piece for p in proto.pieces], [p.type for p in proto.pieces]
        if USER_DEFINED in types or UNUSED in types or proto.denormalizer_spec.precompiled_charsmap:
            raise ValueError("models with user-defined or unused pieces or a denormaliser are not supported")
        usable = [i for i, t in enumerate(types) if t == NORMAL]
        return cls(
            pieces=pieces,
            types=types,
            rank={pieces[i]: proto.pieces[i].score for i in usable},
            ids={pieces[i]: i for i in usable},
            byte_ids={int(p[3:5], 16): i for i, p in enumerate(pieces) if types[i] == BYTE} if trainer.byte_fallback else {},
            bos=pieces.index(trainer.bos_piece),
            eos=pieces.index(trainer.eos_piece),
            unk=types.index(UNKNOWN),
            charmap=CharacterMap(spec.precompiled_charsmap) if spec.precompiled_charsmap else None,
            dummy_prefix=spec.add_dummy_prefix,
            trim=spec.remove_extra_whitespaces,
            escape=spec.escape_whitespaces,
            # No piece has a space mark after another character, so no merge crosses the start of a word.
            splits=not any(SPACE in pieces[i].lstrip(SPACE) for i in usable),
            # No piece has a letter beside another character but marks, so no merge crosses the ends of a run of letters.
            letters_apart=not any(_MIXED(pieces[i].lstrip(SPACE)) for i in usable),
        )

    def normalise(self, text: str) -> str:
        """The text that the pieces cut, without offsets."""
        if self.charmap is not None or self.trim:
            return self.normalise_aligned(text)[0]
        if not text:
            return ""
        text = " " + text if self.dummy_prefix else text
        return text.replace(" ", SPACE) if self.escape else text

    def normalise_aligned(self, text: str) -> tuple[str, list[int]]:
        """The same, and for every normalised byte and the end the source byte it came from."""
        raw = text.encode()
        out, source = self.charmap.apply(raw) if self.charmap else (raw, list(range(len(raw) + 1)))
        if self.trim:
            kept = [i for i, b in enumerate(out) if b != 32 or (i and out[i - 1] != 32)]
            while kept and out[kept[-1]] == 32:
                kept.pop()
            source = [*(source[i] for i in kept), source[kept[-1] + 1] if kept else len(raw)]
            out = bytes(out[i] for i in kept)
        if not out:
            return "", [len(raw)]
        if self.dummy_prefix:
            out, source = b" " + out, [source[0], *source]
        if self.escape:
            width = len(SPACE.encode())
            source = [s for b, s in zip(out, source, strict=False) for _ in range(width if b == 32 else 1)] + source[-1:]
            out = out.replace(b" ", SPACE.encode())
        return out.decode(), source

    def merged(self, word: str) -> list[str]:
        """Byte-pair merges by score, the leftmost first among equals."""
        parts: list[str] = list(word)
        if len(parts) <= SHORT:
            # A queue costs more than it saves here.
            scores = [self.rank.get(a + b, NO_SCORE) for a, b in zip(parts, parts[1:])]
            while scores:
                best = max(scores)
                if best == NO_SCORE:
                    break
                k = scores.index(best)
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                del scores[k]
                if k:
                    scores[k - 1] = self.rank.get(parts[k - 1] + parts[k], NO_SCORE)
                if k < len(scores):
                    scores[k] = self.rank.get(parts[k] + parts[k + 1], NO_SCORE)
            return parts
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        queue = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(parts):
                score = self.rank.get(parts[i] + parts[j])
                if score is not None:
                    heapq.heappush(queue, (-score, i, j, len(parts[i]) + len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while queue:
            _, i, j, size = heapq.heappop(queue)
            if not parts[i] or not parts[j] or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j] = parts[i] + parts[j], ""
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def split(self, word: str) -> list[tuple[int, int]]:
        """(id, bytes of normalised text) of each piece.

        A character without a piece falls back to its bytes, of which the first stands for the whole span.
        """
        out: list[tuple[int, int]] = []
        for piece in self.merged(word):
            width = len(piece.encode())
            if piece in self.ids:
                out.append((self.ids[piece], width))
            elif self.byte_ids:
                out += [(self.byte_ids[b], width if not k else 0) for k, b in enumerate(piece.encode())]
            elif out and out[-1][0] == self.unk:
                out[-1] = self.unk, out[-1][1] + width
            else:
                out.append((self.unk, width))
        return out

    def known(self, word: str) -> bytes:
        """Of a word: each id and the normalised bytes of its piece, as unsigned 32-bit integers."""
        pieces = self.split(word)
        return struct.pack(f"<{2 * len(pieces)}I", *[x for piece in pieces for x in piece])

    def words(self, normal: str) -> list[str]:
        # A run of marks goes with the word behind it.
        if not self.splits:
            return [normal] if normal else []
        return (_LETTERS_APART if self.letters_apart else _WORD).findall(normal)

    def pieces_of(self, text: str) -> tuple[np.ndarray, np.ndarray, str]:
        """The ids of the pieces, the source byte behind each of them, and the decoded text."""
        plain = self.charmap is None and not self.trim and SPACE not in text
        normal, source = (self.normalise(text), None) if plain else self.normalise_aligned(text)
        self.memo.age()
        pairs = np.frombuffer(b"".join(map(self.memo.__getitem__, self.words(normal))), "<u4")
        ids, ends = pairs[::2].copy(), np.cumsum(pairs[1::2], dtype=np.int64)
        if source is not None:
            ends = np.array(source, np.int64)[ends]
        elif len(ends):
            # Nothing but spaces was replaced: the source bytes up to each place are those of no mark, and the spaces.
            raw = np.frombuffer(normal.encode(), np.uint8)
            if self.escape:
                kept = np.cumsum(~_inside_marks(raw), dtype=np.int64)
                ends = kept[ends - 1]
            ends = ends - self.dummy_prefix
        # Pieces spell the text itself, and so do the bytes that stand for whole characters, but not what is unknown.
        text = normal.replace(SPACE, " ") if SPACE in self.ids and not (ids == self.unk).any() else self.joined(ids)
        if self.dummy_prefix and len(ids) and self.types[ids[0]] not in (BYTE, UNKNOWN) and text.startswith(" "):
            text = text[1:]
        return ids, ends, text

    def encode(self, text: str) -> bytes:
        """All ids, begin and end included, as little-endian unsigned 32-bit integers."""
        return struct.pack("<I", self.bos) + self.pieces_of(text)[0].tobytes() + struct.pack("<I", self.eos)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first source byte, byte after the last) of each piece, begin and end left out."""
        ids, ends, _ = self.pieces_of(text)
        ends = ends.tolist()
        return list(zip(ids.tolist(), [0, *ends], ends))

    def joined(self, ids: np.ndarray) -> str:
        """The text of the ids: bytes joined to characters, marks as spaces."""
        if not hasattr(self, "_plain"):
            self._plain = [p.replace(SPACE, " ") if t == NORMAL else "" for p, t in zip(self.pieces, self.types, strict=True)]
            self._is_byte = np.array([t == BYTE for t in self.types])
            self._shown = np.array([t in (NORMAL, BYTE, UNKNOWN) for t in self.types])
            self._plain[self.unk] = " ⁇ "
        if not self._is_byte[ids].any():
            return "".join(map(self._plain.__getitem__, ids.tolist()))
        kept = ids[self._shown[ids]]
        runs = np.flatnonzero(np.diff(self._is_byte[kept].astype(np.int8))) + 1
        out = []
        for part in np.split(kept, runs):
            if self._is_byte[part[0]]:
                out.append(_utf8(bytes(int(self.pieces[i][3:5], 16) for i in part)))
            else:
                out.extend(map(self._plain.__getitem__, part.tolist()))
        return "".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids, the space added in front left out."""
        text = self.joined(ids)
        shown = ids[self._shown[ids]]
        if self.dummy_prefix and len(shown) and self.types[shown[0]] == NORMAL and text.startswith(" "):
            text = text[1:]
        return text


_MARK = SPACE.encode()


def _inside_marks(raw: np.ndarray) -> np.ndarray:
    """Which bytes are the second or third one of a mark."""
    first = np.flatnonzero((raw[:-2] == _MARK[0]) & (raw[1:-1] == _MARK[1]) & (raw[2:] == _MARK[2]))
    out = np.zeros(len(raw), bool)
    out[first + 1] = out[first + 2] = True
    return out


_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
# Runs of letters, and runs of other characters, each with the marks before it.  Raised numbers and fractions are no letters.
_LETTER, _OTHER = r"[^\W\d_²³¹¼½¾]", r"[\W\d_²³¹¼½¾]"
_LETTERS_APART = re.compile(rf"{SPACE}*(?:{_LETTER}+|(?:(?!{SPACE}){_OTHER})+)|{SPACE}+")
_MIXED = re.compile(f"{_LETTER}{_OTHER}|{_OTHER}{_LETTER}").search


def _utf8(raw: bytes) -> str:
    """Valid characters as they are, every other byte as one replacement character."""
    out, at = [], 0
    while at < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + n].decode())
                at += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append(NO_UTF8)
            at += 1
    return "".join(out)


def _model(content: bytes):
    """The model with the words it has met, once in each worker."""
    name = f"sentencepieces {hashlib.sha256(content).hexdigest()}"
    return lambda: kept_in_worker(name, lambda: Model.parse(content))


def _encoded(content: bytes, with_ids: bool):
    held = _model(content)

    def run(batches):
        model = held()
        first, last = struct.pack("<I", model.bos), struct.pack("<I", model.eos)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            n, ids_hash, text_hash, all_ends, all_ids = [], [], [], [], []
            for text in batch.column(1):
                ids, ends, decoded = model.pieces_of(text.as_py() or "")
                packed = first + ids.tobytes() + last
                n.append(len(ids) + 2)
                ids_hash.append(hashlib.sha256(packed).hexdigest())
                text_hash.append(hashlib.sha256(decoded.encode()).hexdigest())
                all_ends.append(ends.astype(np.int32))  # a text has less than 2 GB
                if with_ids:
                    all_ids.append(np.frombuffer(packed, "<u4").astype(np.int32))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32())]
            columns = [batch.column(0), *(pa.array(c, k) for c, k in zip((n, ids_hash, text_hash, all_ends), kinds, strict=True))]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ends"]
            if with_ids:
                columns, names = [*columns, pa.array(all_ids, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _piece_spans(content: bytes):
    held = _model(content)

    def run(batches):
        model = held()
        for batch in batches:
            found = [model.spans(t.as_py() or "") for t in batch.column(1)]
            lists = [pa.array([[s[k] for s in f] for f in found], pa.list_(t)) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["doc_id", "ids", "starts", "ends"])

    return run


def _content(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode_decode(docs: DataFrame, model_path: str, with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256, ends and, if wanted, the ids.

    ``ends`` has for each piece, begin and end left out, the byte of the original text behind it; it begins where the one
    before ends.  A character without a piece falls back to bytes, of which the first stands for the whole of it.
    Begin and end ids are there; a null text counts as empty.  Rows keep their order in a partition, nothing is
    shuffled, repeated rows give repeated results, an empty table none.  Other columns are ignored.  The model
    file is read on the driver and travels with the query.
    """
    kind = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ends array<int>" + ", ids array<int>" * with_ids
    return _texts(docs).mapInArrow(_encoded(_content(model_path), with_ids), kind)


def encode_spans(docs: DataFrame, model_path: str) -> DataFrame:
    """Per document the ids of its pieces and the spans of original UTF-8 bytes they stand for."""
    kind = "doc_id bigint, ids array<int>, starts array<bigint>, ends array<bigint>"
    return _texts(docs).mapInArrow(_piece_spans(_content(model_path)), kind)
