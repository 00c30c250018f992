from collections import Counter, defaultdict

from pyspark.sql import functions as F

from ledgerflow.llm.lines import without_boilerplate


def brute(rows, ratio, least):
    """Distinct texts of a host are its pages."""
    pages, total = defaultdict(Counter), Counter()
    for host, text in {(h or "", t) for h, t in rows}:
        total[host] += 1
        for line in {x.strip(" ") for x in (text or "").split("\n")} - {""}:
            pages[host][line] += 1
    bad = {h: {x for x, n in c.items() if n >= least and n / total[h] > ratio} for h, c in pages.items()}
    return [None if t is None else "\n".join(x for x in t.split("\n") if x.strip(" ") not in bad.get(h or "", ())) for h, t in rows]


def test_against_brute_force(make):
    rows = []
    for i in range(300):
        host = ["a.org", "b.org", "a.org", None][i % 4]
        lines = [f"own line {i}", "menu" if i % 3 else " menu ", f"shared {i % 7}", "", f"rare {i // 2}"]
        rows.append((host, "\n".join(lines[i % 3 :]) if i % 11 else None))
    docs = make([(i, t, None, h) for i, (h, t) in enumerate(rows)])
    for ratio, least in ((0.3, 2), (0.05, 5), (0.9, 1)):
        got = {r["doc_id"]: r["text"] for r in without_boilerplate(docs, F.col("source"), max_ratio=ratio, min_pages=least).collect()}
        assert [got[i] for i in range(300)] == brute(rows, ratio, least)


def test_odd_rows(odd, make):
    clean = without_boilerplate(odd, F.col("source"), max_ratio=0.1, min_pages=2)
    assert clean.columns == odd.columns and clean.count() == odd.count()
    rows = [(r["source"], r["text"]) for r in odd.select("source", "text").collect()]
    texts = {(r["doc_id"], r["text"]) for r in clean.collect()}
    assert {t for _, t in texts} == set(brute(rows, 0.1, 2))
    # Three rows of one text are one page, whose lines no other page shares.
    same = "same text of two rows here"
    assert (6, same) in texts and (7, same) in texts and (1, None) in texts and (2, "") in texts and (3, "   \n\n ") in texts
    assert without_boilerplate(make([]), F.col("source")).collect() == []


def test_sites_are_judged_alike_whatever_their_size(make):
    """A banner on a tenth of the pages goes, a phrase on a fiftieth stays, on 50 pages and on 2000."""
    rows = []
    for host, n in (("small", 50), ("large", 2000)):
        for i in range(n):
            lines = [f"own {host} {i}", *(["banner"] if i % 10 == 0 else []), *(["phrase"] if i % 50 == 1 else [])]
            rows.append((len(rows), "\n".join(lines), None, host))
    got = {r["doc_id"]: r["text"] for r in without_boilerplate(make(rows), F.col("source")).collect()}
    assert all(got[i] == t.replace("\nbanner", "") for i, t, _, _ in rows)


def test_a_copied_text_above_the_ratio_stays(make):
    """6 copies among 250 pages, and copies that are most of a site."""
    copied = "first line of a copied page\nits second line"
    rows = [(i, copied, None, "a.org") for i in range(6)] + [(10 + i, f"page {i}", None, "a.org") for i in range(244)]
    rows += [(1000 + i, copied, None, "b.org") for i in range(300)] + [(2000 + i, f"page {i}", None, "b.org") for i in range(9)]
    got = without_boilerplate(make(rows), F.col("source")).collect()
    assert {(r["doc_id"], r["text"]) for r in got} == {(i, t) for i, t, _, _ in rows}


def test_copies_count_once(make):
    copied = "first line of a copied page\nits second line"
    rows = [(i, copied, None, "a.org") for i in range(40)]
    rows += [(100 + i, f"menu\nown line {i}", None, "a.org") for i in range(200)]
    rows += [(400 + i, "menu\nown line 0", None, "a.org") for i in range(300)]
    clean = without_boilerplate(make(rows), F.col("source"))
    got = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert all(got[i] == copied for i in range(40))
    assert all(got[100 + i] == f"own line {i}" for i in range(200)) and got[400] == "own line 0"
    # The total counts copies once as well: 10 of 201 pages, though 10 of 540 rows.
    rows = [(i, f"ten pages\nown {i}" if i < 10 else f"own {i}", None, "b.org") for i in range(200)]
    rows += [(200 + i, copied, None, "b.org") for i in range(340)]
    got = {r["doc_id"]: r["text"] for r in without_boilerplate(make(rows), F.col("source"), max_ratio=0.02).collect()}
    assert got[0] == "own 0" and got[200] == copied
