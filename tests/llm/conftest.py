import os

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in "documents pages benchmark labels".split():
        path = f"{FOLDER}/{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}{'/*' if os.path.isdir(path) else ''}'")
    return connection
