import os

import pytest

SF_SMALL = "/root/testdata/sf0.001"
SF_TEST = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture
def sf_dir(spark, tmp_path):
    """A folder of tables made of the given frames."""
    def write(**tables):
        for name, frame in tables.items():
            frame.write.mode("overwrite").parquet(os.path.join(str(tmp_path), f"{name}.parquet"))
        return str(tmp_path)

    return write
