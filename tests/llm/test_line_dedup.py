import pytest

from lodestat.llm.line_dedup import dedup_lines

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=10):
    owner, holders = {}, {}
    big = lambda d: (d is None, d or 0)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            k = line.strip(BLANKS).translate(LOWER)
            if len(k) >= least:
                holders.setdefault(k, set()).add(doc)
    owner = {k: min(v, key=big) for k, v in holders.items()}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if (k := x.strip(BLANKS).translate(LOWER)) not in owner or owner[k] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches, fan_in", [(1, 2), (4, 3), (7, 2)])
def test_agrees_with_brute_force(small_docs, batches, fan_in):
    rows = [(r.doc_id, r.text) for r in small_docs.collect()]
    got = dedup_lines(small_docs, batches=batches, fan_in=fan_in).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert sum(r.n_dropped for r in got) > 0


def test_odd_and_empty_tables(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, dedup_lines(odd_docs).collect()), key=str) == brute(rows)
    assert dedup_lines(no_docs).isEmpty()


def test_hot_line_on_every_document(spark):
    docs = spark.range(300).selectExpr("id AS doc_id", "concat('A line on every page\\n', id, ' own words here') AS text")
    got = {r.doc_id: r for r in dedup_lines(docs).collect()}
    assert got[0].n_dropped == 0 and all(got[i].n_dropped == 1 for i in range(1, 300))
