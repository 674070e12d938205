import duckdb
import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Null, empty and blank texts, repeated rows, copies, ties, very long texts and unusual characters.
HARD = [
    (1, "Alpha beta gamma delta epsilon.", "en", "src0", 31),
    (2, "ALPHA beta gamma delta epsilon.", "en", "src0", 31),
    (2, "ALPHA beta gamma delta epsilon.", "en", "src0", 31),
    (3, None, None, None, None),
    (4, "", "", "", 0),
    (5, " \t\n ", "de", "src1", 4),
    (None, "no id here", "fr", "src2", 10),
    (None, None, None, "src3", None),
    (6, "word " * 20_000, "en", "src4", 100_000),
    (7, "x" * 5_000, "en", "src4", 5_000),
    (8, "ÀÉÎ straße ①② 中文 文字   á \U0001f600 end", "es", "unknown", 30),
    (9, "a.b_c@d-e.f.gh, 10.0.0.255 and 256.1.1.1; 4111 1111-1111 1111 or +1 (212) 555-0100.", "en", "src5", 80),
    (10, "Released under the MIT License.\nLicensed under CC BY-NC 4.0.", "en", "src6", 60),
    (11, "alpha BETA gamma delta epsilon.", "en", "src7", 31),
]


@pytest.fixture(scope="session")
def hard(spark):
    return spark.createDataFrame(HARD, DOCUMENT)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture(scope="session")
def clashing(spark, hard):
    """The same rows with further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    names = ["c0", "c1", "_digest", "_size", "key", "kept", "score", "fp", "node", "root", "group", "domain", "_n", "n", "toxic", "label", "id", "codes"]
    return hard.withColumns({n: F.lit(i) for i, n in enumerate(names)})


@pytest.fixture(scope="session")
def tables(sf_dir):
    db = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


@pytest.fixture(scope="session")
def texts(tables):
    return dict(tables.sql("SELECT doc_id, text FROM documents").fetchall())


def rows(df):
    return [tuple(r) for r in df.collect()]

