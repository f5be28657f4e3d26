"""Small tables with the cases every operator must stand."""

import random

DOC_SCHEMA = (
    "doc_id bigint, text string, lang string, source string, _raw bigint, _words int, row string,"
    " score string, kept string, _key int, marks int, uid string"
)


def documents(spark, rows, parts=3):
    """(doc_id, text) rows with further columns whose names the operators use themselves."""
    data = [(i, t, "en", "s", 1, 2, "r", "x", "k", 3, 4, "u") for i, t in rows]
    return spark.createDataFrame(data, DOC_SCHEMA).repartition(parts)


def stored(spark, tmp_path, rows, parts=3):
    """The same as a table of files, which gives the same rows at each reading."""
    path = str(tmp_path / "documents.parquet")
    documents(spark, rows, parts).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def vocabulary(n=80, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefgé", k=rng.randint(2, 7))) for _ in range(n)]


def sentences(n, seed=2, words=(5, 40), voc=None):
    rng = random.Random(seed)
    voc = voc or vocabulary()
    return [" ".join(rng.choices(voc, k=rng.randint(*words))) for _ in range(n)]
