import random
import re
from collections import defaultdict
from itertools import permutations

from ledgerflow.llm.filter_audit import FIGURES, audit


def failures(rows):
    out = []
    for key, text, _, _ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        smaller = key is not None and any(k is not None and k < key and (t or "") == text for k, t, _, _ in rows)
        out.append(
            {
                "A": len(words) < 200,
                "B": 100 * len(set(words)) < 50 * len(words),
                "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                "D": bool(re.search("[#$%&*|]", text)),
                "E": smaller,
            }
        )
    return out


def brute(rows, labels):
    """Every order run over every document."""
    good = {k for k, q, _ in labels if q == 1} - {None}
    toxic = {k for k, _, t in labels if t == 1} - {None}
    fails = failures(rows)
    found = defaultdict(lambda: dict.fromkeys(FIGURES, 0))
    shapley = defaultdict(int)
    for part in {r[2] or "" for r in rows}:
        for order in map("".join, permutations("ABCDE")):
            alive = [i for i, r in enumerate(rows) if (r[2] or "") == part]
            members = list(alive)
            for step, letter in enumerate(order, 1):
                row = found[part, order, step]
                removed = [i for i in alive if fails[i][letter]]
                alive = [i for i in alive if not fails[i][letter]]
                row["kept"], row["removed"] = len(alive), len(removed)
                row["redundant"] = sum(fails[i][letter] for i in members) - len(removed)
                row["unique_fails"] = sum(fails[i][letter] and sum(fails[i].values()) == 1 for i in members)
                row["good_lost"] = sum(rows[i][0] in good for i in removed)
                row["toxic_lost"] = sum(rows[i][0] in toxic for i in removed)
                shapley[part, letter] += len(removed)
    return {k: (*v.values(), shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items()}


def result(frame):
    return {
        (r["part"], r["filter_order"], r["step"]): (*(r[f] for f in FIGURES), r["shapley"]) for r in frame.collect()
    }


def test_against_every_order(spark, make):
    rng = random.Random(5)
    texts = ["", "short", "A" * 40, "w " * 250, " ".join(f"w{i}" for i in range(210)), "ab # " * 120, "\tx\x0by\x85z é"]
    texts += [" ".join(rng.choice(["Word", "x#", "many", f"w{i}"]) for i in range(rng.choice([50, 205, 260]))) for _ in range(30)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "de", None, ""]), None) for i in range(160)]
    rows += [(3, texts[1], "en", None), (None, texts[1], "de", None), (None, None, None, None), (5, None, "en", None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 160, 2)] + [(4, 1, 1), (None, 1, 1)]
    frame = audit(make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert result(frame) == brute(rows, labels)


def test_odd_rows(spark, odd, make):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [tuple(r) for r in odd.select("doc_id", "text", "lang", "source").collect()]
    assert result(audit(odd, none)) == brute(rows, [])
    assert audit(make([]), none).collect() == []
