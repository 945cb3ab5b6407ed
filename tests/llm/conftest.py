import random

import pytest

WORDS = "the of and ston thing ere here anble tion other wh over and in to it ourt".split()


def prose(rng, n):
    out = []
    while len(out) < n:
        k = rng.randint(4, 12)
        s = [rng.choice(WORDS) + rng.choice(["", "", "an", "er", "on"]) for _ in range(k)]
        out += [s[0].title(), *s[1:-1], s[-1] + rng.choice([".", ".", ".\n"])]
    return " ".join(out[:n]).replace("\n ", "\n")


def rows(seed=5):
    """(doc_id, text, lang): plain, empty, null, copies, near copies, shared passages, one very long text, repeated rows."""
    rng = random.Random(seed)
    passage = prose(rng, 70)
    base = prose(rng, 300)
    out = [(k, prose(rng, rng.choice([1, 3, 20, 120, 400])), rng.choice(["en", "de"])) for k in range(30)]
    out += [(30, None, "en"), (31, "", "de"), (32, "   \n", None), (33, base, "en"), (34, base, "en"), (35, base + " tail", "en"), (36, base[:-20], "en")]
    out += [(40 + k, prose(rng, 60) + " " + passage + " " + prose(rng, 40), "en") for k in range(5)]
    out += [(50, prose(rng, 6000), "en"), (51, "a" * 700, "en"), (52, "ab" * 400, "de"), (53, "Élan ça 世界 😀 été. " * 30, "fr"), (54, "7 8 9", None)]
    out += [(60, prose(rng, 50), "en")] * 2
    return out


@pytest.fixture(scope="session")
def doc_rows():
    return rows()


@pytest.fixture(scope="session")
def folder(spark, doc_rows, tmp_path_factory):
    """The documents and labels as a table folder; extra columns have names that operators use inside."""
    at = tmp_path_factory.mktemp("tables")
    extra = [(i, t, lang, "src", len(t or ""), "x", 1, 2.0, "TEXT") for i, t, lang in doc_rows]
    spark.createDataFrame(extra, "doc_id long, text string, lang string, source string, n_chars long, run string, block int, perplexity double, covers string").repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 50, 2)] + [(1, 0, 0), (3, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


@pytest.fixture(scope="session")
def empty_folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("empty")
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{at}/conversations.parquet")
    return str(at)
