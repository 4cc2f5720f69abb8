import re
from collections import Counter

from pagewright.llm.divergence import source_divergence
from tests.llm.conftest import frame, messy_rows, words


def brute(rows, documents, top=10):
    counts, seen, groups = {}, {}, set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[A-Za-z\x80-\U0010ffff]+", text or "")]
        groups.add((lang, source))
        counts.setdefault((lang, source), Counter()).update(found)
        seen.setdefault(lang, Counter()).update(set(found))
    out = []
    for lang in {g[0] for g in groups}:
        kept = sorted(w for w, n in seen[lang].items() if n >= documents)
        own = {so: {w: counts[lang, so][w] for w in kept} for la, so in groups if la == lang}

        def share(n, kept=kept):
            return {w: 1 + 10**9 * (n[w] + 2) // (sum(n.values()) + 2 * len(kept)) for w in kept}

        q = share({w: sum(n[w] for n in own.values()) for w in kept})
        p = {so: share(n) for so, n in own.items()}
        for so in own:
            pairs = {o: sum((p[so][w] - p[o][w]) ** 2 // (p[so][w] + p[o][w]) for w in kept) for o in own if o != so}
            terms = {w: (p[so][w] - q[w]) ** 2 // (p[so][w] + q[w]) for w in kept if own[so][w] and p[so][w] > q[w]}
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items.items(), key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, so, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def told(df):
    return sorted(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in df.collect())


def test_messy_rows_against_brute_force(messy):
    for documents in (1, 2, 3):
        assert told(source_divergence(messy, documents)) == brute(messy_rows(), documents)


def test_sources_of_unequal_sizes_against_brute_force(spark):
    """A source with a third of all rows, one without a kept term, one alone in its language, and ties."""
    rows = [(k, " ".join(words(k, 30, 40)), "en", "big" if k % 3 else f"s{k % 7}") for k in range(90)]
    rows += [(100 + k, "éa ÉA ÀB àb zz", "fr", f"x{k % 2}") for k in range(14)] + [(200, "once", "en", "bare"), (201, "alone", "it", "only"), (202, "", "fr", "")]
    got = told(source_divergence(frame(spark, rows)))
    assert got == brute(rows, 10)
    assert {r[2] for r in got if r[:2] == ("en", "bare")} == {"pair"} and not [r for r in got if r[0] == "it"]


def test_dealt_by_salt(spark, monkeypatch):
    monkeypatch.setattr("pagewright.llm.divergence.GROUPS", 0)
    rows = [(k, " ".join(words(k, 20, 15)), "en", f"s{k % 4}") for k in range(40)]
    assert told(source_divergence(frame(spark, rows))) == brute(rows, 10)


def test_empty_table(nothing):
    assert source_divergence(nothing).count() == 0
