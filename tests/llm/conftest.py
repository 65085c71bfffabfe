import pytest

CLASH = {"n": 1, "at": 2, "key": "k", "node": "x", "size": 3, "start": 4, "words": "w", "_spans": 5}


@pytest.fixture(scope="session")
def documents(spark):
    """(id, text) rows as a documents-like table whose other columns clash with names used inside the operators."""
    def make(rows, **columns):
        names = ["doc_id", "text", *columns, *CLASH]
        data = [(i, t, *[v[k] for v in columns.values()], *CLASH.values()) for k, (i, t) in enumerate(rows)]
        kinds = {"doc_id": "long", "text": "string", "n": "int", "at": "int", "key": "string", "node": "string", "size": "int",
                 "start": "int", "words": "string", "_spans": "int"}
        return spark.createDataFrame(data, ", ".join(f"{c} {kinds.get(c, 'string')}" for c in names))
    return make
