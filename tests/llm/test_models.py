"""Language identification, licence scan and URL filter."""

import itertools
import math
import random
import re
import zlib
from collections import Counter
from urllib.parse import urlsplit

import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import language_id, license_scan, quality_rules, url_filter
from siltworks.llm.queries import op2_license_scan, op3_language_id, op6_url_filter

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    known = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang").collect()}
    rows = op3_language_id(spark, SMALL).collect()
    out = [r for r in rows if r["held_out"]]
    assert len(out) > 200
    assert np.mean([known[r["doc_id"]] == r["lang_pred"] for r in out]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_codewords_are_apart():
    for n in (2, 3, 4, 6, 7, 20):
        code = language_id.codewords(n)
        apart = [(a != b).sum() for i, a in enumerate(code) for b in code[:i]]
        assert min(apart) >= (1 if n == 2 else code.shape[1] // 4)
        assert len({tuple(c * c[0]) for c in code.T}) == code.shape[1]


def test_undetermined_and_single_language(spark, messy):
    for r in op3_language_id(spark, messy).collect():
        if r["doc_id"] in (160, 162, 163, 166):
            assert r["lang_pred"] == "und"
    a, b, c = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1][:3]
    docs = spark.createDataFrame([(a, "a b", "xx", None), (b, "12", "xx", None), (c, "zz", None, None)], "doc_id bigint, text string, lang string, source string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identify(docs).collect()} == {a: "xx", b: "und", c: "xx"}
    none = docs.drop("lang").selectExpr("*", "cast(null as string) AS lang")
    assert {r["lang_pred"] for r in language_id.identify(none).collect()} == {"und"}


def own_words(rng, language):
    """A text of words over three pairs of letters of its own."""
    letters = "bcdfghjklmnpqrstvwxz"
    pairs = [letters[(7 * language + k) % 20] + "aeiou"[language // 20 % 5] + letters[(language + 3 * k) % 20] for k in range(3)]
    return " ".join("".join(rng.choices(pairs, k=2)) for _ in range(40))


def learnable():
    return (i for i in itertools.count() if zlib.crc32(str(i).encode()) % 3 != 1)


def test_every_language_is_learned(spark):
    rng, ids = random.Random(2), learnable()
    rows = [(next(ids), own_words(rng, n), f"l{n:02}") for n in range(70) for _ in range(12 if n < 64 else 6)]
    found = language_id.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2)).collect()
    known = {i: lang for i, _, lang in rows}
    assert {r["lang_pred"] for r in found} == set(known.values())
    assert np.mean([known[r["doc_id"]] == r["lang_pred"] for r in found]) > 0.95


def test_copies_and_texts_without_letters_take_no_place(spark, monkeypatch):
    """The fit sees the same number of distinct texts beside thousands of copies or of texts without a letter."""
    seen = Counter()
    fit = language_id.fit
    monkeypatch.setattr(language_id, "fit", lambda languages, rows: seen.update(lang for lang, _ in rows) or fit(languages, rows))
    rng, ids = random.Random(4), learnable()
    rows = [(next(ids), own_words(rng, n), lang) for n, lang in enumerate(("copied", "letterless", "plain")) for _ in range(320)]
    rows += [(next(ids), rows[0][1], "copied") for _ in range(20_000)] + [(next(ids), f"{i} 42", "letterless") for i in range(20_000)]
    language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(2))
    assert seen == {"copied": 300, "letterless": 300, "plain": 300}


def plain_scan(text, templates=license_scan.TEMPLATES):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    places, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        parts = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    best, more = 0.0, set()
    for label, wording in templates:
        tokens = set(wording.split())
        step = max(32, len(wording.split()))
        for s in range(0, len(words), step):
            share = len(tokens & set(words[s : s + 2 * step])) / len(tokens)
            if share >= license_scan.THRESHOLD:
                best, more = max(best, share), more | {label}
    score = 1.0 if places else best
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)), ",".join(sorted(labels | more)), score


def test_licences(spark, messy, texts):
    found = op2_license_scan(spark, messy).collect()
    assert sorted(map(repr, ((i, *plain_scan(t)) for i, t in texts))) == sorted(repr(tuple(r)) for r in found)


def test_wrapped_and_mixed_notices(spark):
    lines = ["Permission is hereby granted,\nfree of charge, to any person obtaining\na copy of this software and associated documentation files", "MIT-License x MIT  LICENSE", "the mit", "filler " * 100 + "All rights\nreserved " + "filler " * 100]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    found = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(docs).collect()}
    assert found == {i: plain_scan(t) for i, t in enumerate(lines)}
    assert found[0][5] == "mit" and found[3][5] == "proprietary"


def test_long_templates_match_wherever_they_lie(spark):
    """Longer than a step, across blocks, and of more distinct words than a fixed block holds."""
    templates = [("short", "all rights reserved")] + [(f"t{n}", " ".join(f"w{n}x{i}" for i in range(n))) for n in (40, 90)]
    lines = ["filler " * lead + wording for lead in (0, 20, 45, 77) for _, wording in templates]
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    found = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan.scan(docs, templates).collect()}
    assert found == {i: (templates[i % 3][0], 1.0) for i in range(len(lines))}


def test_a_long_template_changes_nothing_for_short_ones(spark):
    """Words of a short template far apart are no notice, whatever templates stand beside it."""
    apart = "all " + "filler " * 149 + "rights " + "filler " * 149 + "reserved"
    docs = spark.createDataFrame([(0, apart)], "doc_id bigint, text string")
    long = ("long", " ".join(f"w{i}" for i in range(1500)))
    for templates in ([("proprietary", "all rights reserved")], [("proprietary", "all rights reserved"), long]):
        assert [(r["labels"], r["score"]) for r in license_scan.scan(docs, templates).collect()] == [("", 0.0)]


def test_full_texts_with_words_left_out(spark):
    """Whole licences within other text, some words lost or changed; fewer than four fifths of the words are no match."""
    rng = random.Random(12)
    lines = []
    for label, wording in license_scan.TEMPLATES:
        words = wording.split()
        for kept in (1.0, 0.9, 0.5):
            some = [w if rng.random() < kept else "changed" for w in words]
            lines.append("filler " * rng.randint(0, 200) + "\n".join(" ".join(some[i : i + 9]) for i in range(0, len(some), 9)) + ", filler" * 50)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    found = {r["doc_id"]: tuple(r)[1:] for r in license_scan.scan(docs).collect()}
    assert found == {i: plain_scan(t) for i, t in enumerate(lines)}
    assert all(label in found[3 * n][5].split(",") for n, (label, _) in enumerate(license_scan.TEMPLATES))


def plain_features(url, host, path):
    query = url.split("#")[0].partition("?")[2]
    shares = [url.count(c) / len(url) for c in set(url)]
    parts = host.split(".")
    wide = 2 if len(parts) > 2 and len(parts[-1]) == 2 and len(parts[-2]) <= 3 else 1
    return {
        "n_chars": len(url),
        "host_chars": len(host),
        "path_chars": len(path),
        "host_parts": len(parts),
        "depth": path.count("/"),
        "digit_ratio": sum(c in "0123456789" for c in url) / max(1, len(url)),
        "hyphens": url.count("-"),
        "entropy": -sum(s * math.log2(s) for s in shares),
        "parameters": len([p for p in query.split("&") if p]),
        "parameter_chars": len(query),
        "fragment": "#" in url,
        "suffix": ".".join(parts[-wide:]),
        "parent": ".".join(parts[-wide - 1 :]),
    }


def test_url_features_equal_plain_ones(spark):
    urls = ["http://a.example.org/x/y?b=1&c=2&&d#e?f=1", "https://WWW.Shop.co.uk/a-b/1", "http://x.com?", "", None, "no scheme", "ftp://h/é?ü=ö", "http://1.2.3.4/", "http://news.bbc.uk/#a=b&c"]
    rows = url_filter.lexical(url_filter.parsed(spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string"))).collect()
    for r in rows:
        for name, value in plain_features(r["url"], r["host"], r["path"]).items():
            assert r[name] == (value if isinstance(value, str) else pytest.approx(float(value), abs=1e-12)), (name, r["url"])


def test_rates_leave_the_own_label_out(spark):
    rows = [(i, f"http://{'ab'[i % 2]}{i % 4}.x{i % 3}.net/{i}", label) for i, label in enumerate([1, 0, 1, 1, None, 0, 0, 1, None, 1, 0, 1])]
    urls = url_filter.lexical(url_filter.parsed(spark.createDataFrame(rows, "page_id bigint, url string, label int")).join(spark.createDataFrame(rows, "id bigint, u string, label int").drop("u"), F.col("page_id") == F.col("id")))
    labels = [label for _, _, label in rows if label is not None]
    overall, k = sum(labels) / len(labels), url_filter.PRIOR
    of = {i: (u.split("/")[2].split(".")[-1], ".".join(u.split("/")[2].split(".")[-2:])) for i, u, _ in rows}

    def rate(i, place, towards):
        same = [label for j, _, label in rows if j != i and label is not None and of[j][place] == of[i][place]]
        return (sum(same) + towards * k) / (len(same) + k)

    for r in url_filter._with_rates(urls).collect():
        suffix = rate(r["page_id"], 0, overall)
        assert r["suffix_rate"] == pytest.approx(suffix) and r["parent_rate"] == pytest.approx(rate(r["page_id"], 1, suffix))


def test_a_rare_kind_is_sampled_whole(spark):
    """Three blocked URLs among a hundred thousand: all three are learned from, and of the others no more than the bound says."""
    urls = spark.range(100_000).selectExpr("id AS page_id", "concat('http://h', id % 50000, '.net/') AS url", "int(id IN (7, 70, 700)) AS label")
    sample = url_filter.training_sample(urls, 2000).groupBy("label").count().collect()
    found = {r["label"]: r["count"] for r in sample}
    assert found[1] == 3 and 850 < found[0] < 1150
    whole = url_filter.training_sample(urls.filter("page_id < 1000"), 20_000)
    assert whole.count() == whole.select("url").distinct().count() == 1000


def test_decoding_equals_plain_decoding():
    """Loss-weighted decoding, the flag and the trust, word for word."""
    rng = np.random.default_rng(8)
    for n in (2, 3, 7):
        names = [f"l{i}" for i in range(n)]
        rows = [(names[i % n], language_id.features(own_words(random.Random(i), i % n))) for i in range(20 * n)]
        model = language_id.fit(names, rows)
        assert model.code.tolist() == language_id.codewords(n).tolist()
        for i, name in enumerate(names):
            mine = [x for lang, x in rows if lang == name]
            right = [np.mean([model.code[i][b] * (x @ model.weights[:, b] + model.bias[b]) > 0 for x in mine]) for b in range(model.code.shape[1])]
            trust = [max(r - 0.5, 1e-3) for r in right]
            assert np.allclose(model.trust[i], np.array(trust) / sum(trust), atol=1e-5)
        for k in range(30):
            text = own_words(random.Random(1000 + k), k % n) + " " + own_words(random.Random(2000 + k), int(rng.integers(n)))
            x = language_id.features(text)
            losses = []
            for i in range(n):
                loss = 0.0
                for b in range(model.code.shape[1]):
                    says = float(x @ model.weights[:, b] + model.bias[b])
                    loss += float(model.trust[i][b]) * math.log1p(math.exp(-float(model.code[i][b]) * says))
                losses.append(loss)
            order = sorted(range(n), key=lambda i: losses[i])
            language, score, ambiguous = model.predict(text)
            if losses[order[1]] - losses[order[0]] > 1e-5:
                assert language == names[order[0]]
            assert score == pytest.approx(1 / sum(math.exp(min(losses) - loss) for loss in losses), rel=1e-4)
            if abs(losses[order[1]] - losses[order[0]] - language_id.MARGIN) > 1e-5:
                assert ambiguous == (losses[order[1]] - losses[order[0]] < language_id.MARGIN)


def test_prior_takes_chance_off():
    """Hosts that differ by chance alone get a strong prior, hosts that differ really a weak one, whatever their sizes."""
    rng = random.Random(3)

    def strength(rate_of):
        hosts = []
        for h in range(400):
            n = rng.choice([1, 1, 2, 5, 40])
            rate = rate_of(h)
            hosts.append((n, sum(rng.random() < rate for _ in range(n))))
        sums = len(hosts), sum(n for n, _ in hosts), sum(f for _, f in hosts), float(sum(n * n for n, _ in hosts)), sum(f * f / n for n, f in hosts)
        return quality_rules.prior(*sums)[1]

    assert strength(lambda h: 0.3) > 50
    assert strength(lambda h: 0.05 if h % 2 else 0.9) < 3
    assert quality_rules.prior(0, 0, 0, 0.0, 0.0) == (0.0, quality_rules.STRONGEST)
    assert quality_rules.prior(3, 9, 9, 27.0, 9.0)[1] == quality_rules.STRONGEST


def test_url_parts_and_rules(spark):
    rows = op6_url_filter(spark, SMALL).collect()
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    for r in rows:
        parts = urlsplit(pages[r["page_id"]])
        assert (r["host"], r["path"]) == (parts.netloc.lower(), parts.path)
        fits = [(len(h + p), v, h + p) for v, h, p in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        assert r["rule"] == (max(fits)[2] if fits else None)
        assert r["verdict"] == max(fits)[1] if fits else r["verdict"] in ("allow", "block")


def test_url_edges(spark, messy):
    rows = {r["page_id"]: r for r in op6_url_filter(spark, messy).collect()}
    assert (rows[2]["host"], rows[2]["path"], rows[2]["rule"]) == ("", "", None)
    assert (rows[4]["host"], rows[4]["path"], rows[4]["verdict"]) == ("www.x.com", "/de/1", "block")
    assert rows[1]["rule"] == "example.org/es/" and rows[None]["rule"] is None
    assert Counter(r["page_id"] for r in op6_url_filter(spark, messy).collect())[3] == 2


def test_trees_learn_held_out_labels(spark):
    """Rules for half of the hosts; the other half is judged by the trees."""
    urls = [(i, f"http://host{i}.{'bad' if i % 2 else 'good'}.net/{'x/' * (1 + i % 2 * 4)}{i if i % 2 else 'page'}") for i in range(400)]
    rules = [("block" if i % 2 else "allow", f"host{i}.{'bad' if i % 2 else 'good'}.net", "/") for i in range(60)]
    found = url_filter.judge(spark.createDataFrame(urls, "page_id bigint, url string"), rules).collect()
    judged = [r for r in found if r["rule"] is None]
    assert len(judged) == 340
    assert np.mean([(r["verdict"] == "block") == bool(r["page_id"] % 2) for r in judged]) > 0.95


def test_labels_of_one_kind(spark):
    pages = spark.createDataFrame([(1, "http://a.org/"), (2, "http://b.net/")], "page_id bigint, url string")
    assert {r["verdict"] for r in url_filter.judge(pages).collect()} == {"allow"}
    assert {r["verdict"] for r in url_filter.judge(pages, []).collect()} == {"allow"}
