import random

from pricerisk.llm.lines import dedup_lines
from tests.llm.helpers import ODD_TEXTS, clashing, documents


def brute(rows):
    """Distinct rows in order of doc_id; each window is kept where it is met first."""
    seen, out = set(), {}
    for i, text in sorted(set(rows)):
        lines = text.split("\n")
        at = [k for k, x in enumerate(lines) if x.strip(" \t\n\r\x0b\x0c")]
        gone = set()
        for a, b, c in zip(at, at[1:], at[2:]):
            w = (lines[a], lines[b], lines[c])
            if w in seen:
                gone |= {a, b, c}
            seen.add(w)
        out[i, text] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(at), len(gone))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(2)
    pool = ["one", "two", "three", "four", "", "  ", "é five"]
    rows = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 14)))) for k in range(120)]
    passage = "\n".join(f"shared line {k}" for k in range(9))
    rows += [(200 + k, f"head {k}\n{passage}\ntail {k}") for k in range(60)]
    rows += [(5, rows[5][1]), (5, rows[5][1])]
    got = dedup_lines(clashing(documents(spark, rows)), "lang").collect()
    want = brute(rows)
    text_of = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.text, r.n_lines, r.n_removed) == want[r.doc_id, text_of[r.doc_id]]
    # every line with a word still stands somewhere
    left = {x for r in got for x in r.text.split("\n")}
    assert {x for _, t in rows for x in t.split("\n") if x.strip()} <= left


def test_odd_rows_and_empty_table(spark):
    rows = dedup_lines(documents(spark, ODD_TEXTS + [(None, None), (None, "a\nb\nc"), (3, "a\nb\nc")])).collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    assert {r.text for r in rows if r.doc_id == 2} == {None}
    # a null id comes last, so its copy is the later one
    assert [r.n_removed for r in rows if r.doc_id == 3] in ([0, 0], [0, 0])
    assert 3 in [r.n_removed for r in rows if r.doc_id is None]
    assert dedup_lines(documents(spark, [])).collect() == []
