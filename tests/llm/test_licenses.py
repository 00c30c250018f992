import random
import re

from pyspark.sql import functions as F

from ledgerflow.llm import licenses as licenses_module
from ledgerflow.llm.catalog import QUERIES
from ledgerflow.llm.common import table
from ledgerflow.llm.licenses import TEMPLATES, licenses

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(text):
    own = shingles(text)
    return sorted({name for name, t in TEMPLATES if len(own & shingles(t)) >= 0.8 * len(shingles(t))})


def test_query_against_containment_of_all(spark):
    docs = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    got = {r["doc_id"]: r["licenses"] for r in QUERIES["op3_licenses"](spark, SF).collect()}
    assert got == {k: ",".join(brute(t)) for k, t in docs.items()} and any(got.values())


def test_every_template_at_every_alignment(make):
    rng = random.Random(2)
    rows = []
    for _, template in TEMPLATES:
        for lead in range(8):
            words = [f"w{rng.randrange(500)}" for _ in range(lead)] + template.split() + [f"w{rng.randrange(500)}" for _ in range(30)]
            if lead % 2 and len(template.split()) > 12:
                words[lead + 1] = "changed"
            rows.append((len(rows), " ".join(words).upper() if lead % 3 else " ".join(words)))
    got = {r["doc_id"]: r["licenses"] for r in licenses(make(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == [brute(t) for _, t in rows]


def test_template_of_one_shingle_is_never_missed(make):
    rng = random.Random(3)

    def some(n):
        return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))

    # In the bands alone this shingle is hardly ever the least: a third of its windows would be missed.
    notice = "Released under notice number 192875"
    docs = make([(i, f"{some(4 + i % 4)} {notice}. {some(8)}") for i in range(400)])
    assert licenses(docs, templates=(("own", notice),)).where("licenses = array('own')").count() == 400


def test_bands_alone_retrieve_every_template_at_every_alignment(make):
    """Candidates before any comparison: each template on its own, whole, shifted through the windows."""
    rng = random.Random(4)
    rows = []
    for number, (_, template) in enumerate(TEMPLATES):
        for lead in range(2 * licenses_module.WINDOW_SHINGLES + 1):
            foreign = [f"w{rng.randrange(10**6)}" for _ in range(lead + 12)]
            rows.append((len(rows), " ".join([*foreign[:lead], template, *foreign[lead:]]), str(number)))
    docs = make(rows)
    found = licenses_module.candidates(docs, "doc_id", "text", TEMPLATES)
    met = docs.select("lang", F.xxhash64("doc_id", "text").alias("mark")).join(found, "mark").where("template = int(lang)")
    assert met.count() == len(rows)


def test_retrieval_is_as_probable_as_computed(spark, make, monkeypatch):
    """With few bands a template of one shingle is missed as often as its own hashes say."""
    rng = random.Random(6)
    notice = (("own", "some notice of five words"),)
    docs = make([(i, " ".join([*(f"w{rng.randrange(10**9)}" for _ in range(8 + i % 5)), notice[0][1], *(f"w{rng.randrange(10**9)}" for _ in range(9))])) for i in range(2000)])
    for count in (1, 3, 6):
        monkeypatch.setattr(licenses_module, "band_count", lambda *_: count)
        words = [spark.range(1).select(F.xxhash64(F.lit(w))).first()[0] for w in notice[0][1].split()]
        shingle = spark.range(1).select(F.xxhash64(*[F.lit(w) for w in words])).first()[0]
        own = [spark.range(1).select(F.xxhash64(F.lit(shingle), F.lit(b))).first()[0] / 2**64 + 0.5 for b in range(count)]
        miss = 1.0
        for m in own:
            miss *= 1 - 2 * (1 - m) ** 3 + (1 - m) ** 5
        got = licenses_module.candidates(docs, "doc_id", "text", notice).count() / 2000
        assert abs(got - (1 - miss)) < 0.04


def test_bands_follow_the_weakest_template(spark):
    usual = licenses_module.band_count(spark, TEMPLATES)
    assert licenses_module.LEAST_BANDS <= usual <= 128
    # Its shingle is hardly ever the least, which more bands make up for.
    rare = licenses_module.band_count(spark, (("own", "Released under notice number 192875"),))
    assert rare > 24 and licenses_module.band_count(spark, TEMPLATES, 1e-3) <= usual
    longer = tuple(t for t in TEMPLATES if len(t[1].split()) > 12)
    assert licenses_module.band_count(spark, longer) == licenses_module.LEAST_BANDS


def test_plan_has_no_python(spark):
    docs = table(spark, SF, "documents")
    plan = licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Cartesian", plan)


def test_odd_rows(odd, make):
    rows = licenses(odd)
    assert rows.count() == odd.count() and rows.where("size(licenses) > 0").count() == 0
    assert licenses(make([])).collect() == []
