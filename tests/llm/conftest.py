import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, size long, node string, spans string, "
          "copies int, `key` string, word string, target double, draw double, kinds string, rate double, doc string, length int, _id long, _n int, _row long, uid long")
EXTRA = (0.5, 7, "n", "s", 1, "k", "w", 1.0, 2.0, "x", 3.0, "d", 9, 1, 2, 3, 4)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()


def text(n, seed=0):
    return " ".join(f"{WORDS[(i * i + seed) % 12]}{(i * (seed + 3)) % 17}" for i in range(n))


LONG = text(120_000)
ROWS = [
    (1, text(60), "en", "a"), (2, text(60), "en", "a"), (3, text(60, 5), None, "b"), (3, text(60, 5), None, "b"),
    (4, None, "en", "a"), (5, "", "fr", None), (6, LONG, "en", "c"), (7, "one", "fr", "c"), (8, "\n \t", "fr", None),
    (None, text(40, 2), "fr", None), (None, None, None, None), (9, "密码 привет γειά", "fr", "a"), (10, "a\u0000b  c", "en", "z"),
]


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """Documents with nulls everywhere, empty and very long texts, repeated rows
    and extra columns named like the operators' own; a table of files."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    rows = [(i, t, la, s, None if t is None else len(t), *EXTRA) for i, t, la, s in ROWS]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}
