import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table from texts, (text, source) pairs or (doc_id, text, source) triples."""

    def make(*rows, extra=""):
        full = []
        for i, row in enumerate(rows):
            row = row if isinstance(row, tuple) else (row,)
            doc_id, text, source = row if len(row) == 3 else (i, *row, *["src0"][: 2 - len(row)])
            full.append((doc_id, text, "en", source, len(text or "")) + (("x",) * (extra.count(",") + 1) if extra else ()))
        return spark.createDataFrame(full, DOCUMENT + (f", {extra}" if extra else ""))

    return make


@pytest.fixture(scope="session")
def as_tables(tmp_path_factory):
    """Writes tables as a data folder, so that a registered query can read them."""

    def write(**tables):
        folder = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return str(folder)

    return write
