import random

from pagewright.llm.line_dedup import drop_repeated_lines
from tests.llm.conftest import frame, messy_rows


def brute(rows):
    """Rows in order of doc_id (null last), first of equal rows first; windows seen before cover their lines."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    first, out = {}, []
    for k in order:
        i, t = rows[k][:2]
        lines = [] if t is None else t.split("\n")
        gone = set()
        for p in range(len(lines) - 2):
            w = tuple(lines[p : p + 3])
            if "".join(w).strip(" "):
                if w in first:
                    gone |= {p, p + 1, p + 2}
                first.setdefault(w, (k, p))
        left = None if t is None else "\n".join(x for p, x in enumerate(lines) if p not in gone)
        out.append(str((i, left, len(lines), len(gone))))
    return sorted(out)


def check(df, rows):
    got = drop_repeated_lines(df).collect()
    assert sorted(str((r["doc_id"], r["text"], r["n_lines"], r["n_removed"])) for r in got) == brute(rows)
    for r in got:
        assert r["n_removed"] == sum(int(b) - int(a) + 1 for a, b in (s.split("-") for s in r["removed"].split(",") if s))


def test_messy_rows(messy):
    check(messy, messy_rows())


def test_random_lines(spark):
    rnd = random.Random(8)
    rows = [(k, "\n".join(rnd.choice(["a", "b", "", " ", "c d"]) for _ in range(rnd.randint(1, 12))), "en", "a") for k in range(300)]
    check(frame(spark, rows), rows)


def test_passages_of_many_documents(spark):
    passage = "\n".join(f"shared line {k} with several words" for k in range(5))
    rows = [(k, f"own {k}\n{passage}\nend {k}\n{k}\nx{k}", "en", "a") for k in range(200)]
    check(frame(spark, rows), rows)


def test_nothing(nothing):
    assert drop_repeated_lines(nothing).count() == 0
