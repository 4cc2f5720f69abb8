import random
import re

import pytest

from pagewright.llm import license_scan as L
from pagewright.llm.license_scan import license_scan
from pagewright.llm.shared import documents
from tests.llm.conftest import frame, messy_rows, words


def brute(text, notices=L.NOTICES, percent=80):
    """n_words, n_base, first, last, base labels, labels, score, blocks: all sets against all notices."""
    found = re.findall("[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, base = [], set()
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        own = [k for k in range(len(found)) if found[k : k + len(phrase.split())] == phrase.split()]
        places += own
        base |= {label} if own else set()
    labels, held, blocks = set(base), 0.0, 0
    for start in range(0, max(len(found) - 128, 1), 128):
        block = found[start : start + 256]
        pairs, hit = set(zip(block, block[1:])), False
        for label, notice in notices:
            w = re.findall("[a-z0-9]+", notice.lower())
            own = set(zip(w, w[1:]))
            if 100 * len(own & pairs) >= percent * len(own):
                labels, held, hit = labels | {label}, max(held, len(own & pairs) / len(own)), True
        blocks += hit
    return (len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if places else held, blocks)


def told(df):
    return sorted((str(r["doc_id"]), str(tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_blocks")))) for r in df.collect())


def made(n):
    """Texts with notices whole, changed in some words, cut, in pieces, and across the edges of blocks."""
    rnd, rows = random.Random(7), []
    for k in range(n):
        body = words(k, rnd.choice([0, 3, 40, 120, 127, 128, 129, 250, 256, 257, 700]), 300)
        for _ in range(rnd.randint(0, 3)):
            w = rnd.choice(L.NOTICES)[1].split()
            kind = rnd.random()
            if kind < 0.3:
                w[rnd.randrange(len(w))] = "changed"
            elif kind < 0.5:
                w = w[rnd.randint(0, 3) :]
            elif kind < 0.6:
                w = [x for y in w for x in (y, "and")]
            at = rnd.randint(0, len(body))
            body[at:at] = w
        rows.append((k, " ".join(body), "en", "a"))
    return rows


def test_made_texts_against_all_pairs(spark):
    rows = made(400)
    got = told(license_scan(frame(spark, rows)))
    assert got == sorted((str(r[0]), str(brute(r[1]))) for r in rows)
    assert sum("," in r[1] for r in got) and len({r[1] for r in got}) > 50


@pytest.mark.parametrize("percent", [50, 95])
def test_other_thresholds(spark, percent):
    rows = made(150)
    assert told(license_scan(frame(spark, rows), percent=percent)) == sorted((str(r[0]), str(brute(r[1], percent=percent))) for r in rows)


def test_messy_rows_and_nothing(messy, nothing):
    assert told(license_scan(messy)) == sorted((str(r[0]), str(brute(r[1]))) for r in messy_rows())
    assert license_scan(nothing).count() == 0


def test_labels_beyond_the_phrases(spark):
    """On a whole table: notices that no base phrase names, and no label on texts that speak of no license."""
    docs = documents(spark, "/root/testdata/sf0.01")
    got = {r["doc_id"]: r for r in license_scan(docs).collect()}
    more = [r for r in docs.collect() if got[r["doc_id"]]["labels"] != got[r["doc_id"]]["base_labels"]]
    assert more and all(re.search("(?i)licensed?|permission|redistribut", r["text"]) for r in more)


def test_a_notice_must_fit(spark, nothing):
    with pytest.raises(ValueError, match="2 to 128"):
        license_scan(nothing, notices=[("x", "word " * 200)])
