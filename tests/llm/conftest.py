import pytest


@pytest.fixture(scope="session")
def rows_of():
    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return rows
