import pytest
from pyspark.sql import functions as F

from ledgerflow.llm.catalog import QUERIES, held_out
from ledgerflow.llm.common import table
from ledgerflow.llm.langid import UNKNOWN, fit, identify

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op6_language"](spark, SF)
    truth = table(spark, SF, "documents").select("doc_id", "lang", "n_chars")
    judged = rows.where("held_out").join(truth, "doc_id").where("n_chars > 40")
    good, all_ = judged.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert all_ > 150 and good / all_ > 0.95
    assert rows.where("score < 0 or score > 1 or score is null").count() == 0


def test_odd_rows(spark, odd, make):
    model = fit(make([(i, t, g) for i, (t, g) in enumerate([("the house and word", "en"), ("das haus und der", "de")] * 5)]))
    rows = identify(odd, model).collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == UNKNOWN) != letters and 0 <= r["score"] <= 1
    assert identify(odd, model).columns == [c for c in odd.columns if c != "score"] + ["lang_pred", "score"]


def test_nothing_learned(odd, make):
    model = fit(make([]))
    assert {r["lang_pred"] for r in identify(odd, model).collect()} == {UNKNOWN}
    assert identify(make([]), model).collect() == []


def test_neighbours_do_not_matter(make):
    model = fit(make([(1, "the house and the tree", "en"), (2, "la maison et les arbres", "fr")]))
    texts = ["the", "", "les arbres", None, "12 34", "maison"]
    together = model.score([t or "" for t in texts])
    for t, label, score in zip(texts, *together):
        alone = model.score([t or ""])
        assert alone[0][0] == label and alone[1][0] == pytest.approx(score)


def test_bounded_sample(make):
    docs = make([(i, f"the word {i} and more of it", "en") for i in range(400)] + [(i, f"el texto {i} de la casa", "es") for i in range(400)])
    model = fit(docs, rows=100)
    assert model.languages == ["en", "es"] and model.score(["la casa", "the more"])[0] == ["es", "en"]


def _buckets(text):
    """2- and 3-grams around every letter, one code point at a time."""
    points = [ord(c) if c.isalpha() else 32 for c in "\n" + text.lower() + "\n"]
    m = 0xFFFFFFFF
    found = []
    for i in range(1, len(points) - 1):
        if points[i] != 32:
            pair = points[i - 1] * 0x9E3779B1 & m ^ points[i] * 0x85EBCA77 & m
            triple = pair * 0xC2B2AE3D & m ^ points[i + 1] * 0x27D4EB2F & m
            pair = (pair ^ pair >> 15) * 0x2C1B3C6D & m
            triple = (triple ^ triple >> 15) * 0x297A2D39 & m
            found += [pair >> 16, triple >> 16]
    return found


def test_against_plain_naive_bayes(spark, make):
    """Dictionaries of counts and sums of logarithms, text by text."""
    from collections import Counter
    from math import exp, log

    source = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang").collect()]
    rows = source + [(9000 + i, t, g) for i, (_, t, g) in enumerate(source[:30])]  # copies are one text
    model = fit(make(rows))
    texts = {(t, g) for _, t, g in rows if t is not None and g is not None}
    counts = {g: Counter() for _, g in texts}
    for t, g in texts:
        counts[g].update(_buckets(t))
    counts = {g: c for g, c in counts.items() if c}
    mass = max(sum(c.values()) for c in counts.values())
    probes = [t for _, t, _ in source[:60] if t] + ["the", "日本", "12 34", "x"]
    labels, scores = model.score(probes)
    for text, label, score in zip(probes, labels, scores, strict=True):
        grams = _buckets(text)
        total = {
            g: log(sum(x == g for _, x in texts) / len(texts))
            + sum(log((c[b] * mass / sum(c.values()) + 0.5) / (mass + 0.5 * 65536)) for b in grams)
            for g, c in counts.items()
        }
        best = max(total, key=total.get)
        if not grams:
            assert (label, score) == (UNKNOWN, 0)
        else:
            assert score == pytest.approx(1 / sum(exp(v - total[best]) for v in total.values()), abs=1e-3)
            assert label == best or score < 0.51


def test_a_rare_language_takes_no_foreign_text(make):
    """One text of a fifth language among thousands: it is learned, and nothing unknown is given to it."""
    rows = [(i, f"the word {i} and more of it here", "en") for i in range(900)] + [(i, f"el texto {i} de la casa", "es") for i in range(900)]
    rows += [(i, f"das haus {i} und der baum", "de") for i in range(900)] + [(5000, "zyzzy qoxqox", "zz"), (5001, "123 456", "nn")]
    model = fit(make(rows), rows=200)
    assert model.languages == ["de", "en", "es", "zz"]
    labels, scores = model.score(["Ελληνικά κείμενα", "русский текст", "日本語の文章", "zyzzy qoxqox", "das haus und der baum"])
    assert "zz" not in labels[:3] and max(scores[:3]) < 0.5 and labels[3:] == ["zz", "de"]


def test_a_copied_text_is_drawn_once(make):
    """One text in most of the rows does not outweigh the others, nor fill the sample."""
    rows = [(i, "the same copied page of one text", "en") for i in range(3000)] + [(i, f"el texto {i} de la casa", "es") for i in range(300)]
    model = fit(make(rows), rows=100)
    assert model.score(["the same page", "el texto de la casa"])[0] == ["en", "es"]
    assert model.priors[0] < -5


def test_held_out_is_crc_modulo_four(spark):
    import zlib

    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in rows)
