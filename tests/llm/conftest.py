import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, extra=()):
        """Rows of (doc_id, text[, lang, source]); ``extra`` adds constant string columns."""
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        for name in extra:
            from pyspark.sql import functions as F
            df = df.withColumn(name, F.lit("mine"))
        return df

    return make


@pytest.fixture(scope="session")
def prose():
    """A function of (seed, number of words): prose without repeated passages."""
    import random

    def make(seed, n):
        rng = random.Random(seed)
        common = ["the", "of", "and", "to", "in", "is"]
        out = []
        for i in range(n):
            out.append(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(4, 9))))
            if i % 12 == 11:
                out[-1] += "."
        return " ".join(out)

    return make


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
