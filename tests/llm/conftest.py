import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, own int, digest string, batch int, words string, fp string, t string, key string, kept string"

VECTORS = "vec_id bigint, embedding array<float>, label int, vector string, cluster string, block int, code string, error double"
ITEMS = "item_id bigint, text string, window int, tokens string, digest string, words string, doc_id bigint"


def vector_rows():
    """Vectors near a few centres, with a vector on a third of all rows, ties, repeated rows and rows that cannot be used."""
    rng = random.Random(9)
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(64)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(400)]
    rows += [(1000 + i, list(centres[0]), 1) for i in range(250)]
    rows += [(2000 + i, [float(i % 2)] * 64, None) for i in range(6)]  # ties
    rows += [rows[5], rows[5], (None, list(centres[1]), 3), (None, list(centres[1]), 3), (None, list(centres[2]), 3)]
    rows += [(3000, None, 1), (3001, [], 1), (3002, [0.5] * 63, 1), (3003, [0.5] * 65, 1), (3004, [None] + [0.5] * 63, 1)]
    rows += [(3005, [float("nan")] + [0.5] * 63, 1), (3006, [float("inf")] + [0.5] * 63, 1), (3007, [0.5] * 63 + [float("-inf")], 1)]
    return [(i, v, label, "v", "c", 1, "x", 2.0) for i, v, label in rows]


def item_rows(texts):
    """Items that documents hold whole, in part, or not, of many and few words, repeated, empty and null."""
    whole = [t for _, t in texts if t and len(t.split()) > 25]
    rows = [(i, " ".join(whole[i].split()[3:20]) + " something of its own entirely") for i in range(12)]
    rows += [(20, "X"), (21, "license ÜNDER"), (22, "  $$ "), (23, None), (24, ""), (25, "never seen in any of these"), (None, " ".join(whole[3].split()[:14]))]
    rows += [rows[0], (0, " ".join(whole[5].split()[6:18])), (30, "ab" * 700), (31, "日本語 endoftext text"), (32, "42")]
    return [(i, t, 1, "t", "d", "w", 7) for i, t in rows]


def sentence(rng, n):
    return " ".join(rng.choice(["the", "of", "Ünder", "stone", "river", "42", "éa", "walk", "MIT", "license"]) + rng.choice(["", ",", "."]) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text) with copies, near copies, shared passages, empty and null texts, ties and repeated rows."""
    rng = random.Random(5)
    long = sentence(rng, 400)
    passage = sentence(rng, 60)
    rows = [(i, sentence(rng, rng.randint(1, 120))) for i in range(40)]
    rows += [(100 + i, long if i % 2 else long.replace(" ", "\n", 3)) for i in range(6)]
    rows += [(120 + i, long + f" extra{i}") for i in range(5)]
    rows += [(140 + i, sentence(rng, 30) + " " + passage + " " + sentence(rng, 30)) for i in range(6)]
    rows += [(160, None), (161, None), (162, ""), (163, "   \n\t"), (164, "ab" * 700), (165, "a" * 600), (166, "$$$ *** ### 12 34"), (167, "x")]
    rows += [(168, "line one\nline one\nline one\n" * 30), (169, "日本語 <|endoftext|> text 😀 \x00 \x1c end  two   spaces \n\n"), (170, sentence(rng, 5000))]
    rows += [rows[3], rows[44], (None, "no id"), (None, None), (None, long)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, tmp_path_factory, texts):
    """Folder with those documents, null labels and extra columns of clashing names."""
    folder = str(tmp_path_factory.mktemp("messy"))
    rng = random.Random(1)
    rows = [
        (i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "a", "a", "b", None]), None if t is None else len(t), "r", 1, None, 2, "w", "f", "t", None, "k")
        for i, t in texts
    ]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    urls = [(1, "http://a.example.org/es/x"), (2, None), (3, "no scheme"), (3, "no scheme"), (4, "HTTPS://WWW.X.Com/de/1?a=b&c=d#e"), (None, "http://x.org"), (6, "http://y.com/fr/é" + "z" * 5000)]
    urls += [(10 + i, f"http://h{i}.example.{'com' if i % 2 else 'net'}/{'de' if i % 3 else 'fr'}/{i}") for i in range(40)]
    rows = [(i, u, "<p>", 1.0, "x", 0.5, "y") for i, u in urls]
    spark.createDataFrame(rows, "page_id bigint, url string, html string, label double, host string, score double, features string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(vector_rows(), VECTORS).repartition(3).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame(item_rows(texts), ITEMS).repartition(2).write.parquet(f"{folder}/benchmark.parquet")
    return folder


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("empty"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "page_id bigint, url string, html string").write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame([], VECTORS).write.parquet(f"{folder}/embeddings.parquet")
    spark.createDataFrame([], ITEMS).write.parquet(f"{folder}/benchmark.parquet")
    return folder
