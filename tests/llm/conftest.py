"""Small tables in a folder laid out like the given ones."""

import pytest


@pytest.fixture(scope="session")
def tables(spark, tmp_path_factory):
    """A function: (name=DataFrame, ...) -> a new folder with these tables."""

    def write(**frames):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in frames.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write

