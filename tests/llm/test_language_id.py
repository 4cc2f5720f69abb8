import functools
import math
import random
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from pagewright.llm import language_id as L
from pagewright.llm.language_id import accepted, fold, gram_counts, identify, train, word_scores, words_of
from pagewright.llm.shared import documents
from tests.llm.conftest import frame, messy_rows


def test_small_table_is_told_apart(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    got = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.98 * len(held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    assert sum(r["rejected"] for r in got) <= 0.01 * len(got)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(CAST(doc_id AS string)) % 3 = 1 THEN 'zz' ELSE lang END AS lang", "'x' AS source")
    a, b = ({r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(d).collect()} for d in (docs, other))
    assert a == b


def test_probabilities_are_interpolated_kneser_ney(spark):
    """Against a direct reckoning over dictionaries, for every character that can follow."""
    texts = ["abra cadabra abrac", "barb drab abba", "crab"]
    df = spark.createDataFrame([("x", t) for t in texts], "lang string, text string")
    languages, (model,) = L.models_of(gram_counts(df))
    assert languages == ["x"]
    edge, seen = chr(L.EDGE), {}
    for w in (w for t in texts for w in words_of(t)):
        padded = edge + w + edge
        for k in range(1, L.ORDER + 1):
            for j in range(max(k - 1, 1), len(padded)):
                g = padded[j - k + 1 : j + 1]
                seen[g] = seen.get(g, 0) + 1
    left = {}
    for g in seen:
        if len(g) > 1:
            left.setdefault(g[1:], set()).add(g[0])
    value = {g: n if len(g) == L.ORDER or g not in left else len(left[g]) for g, n in seen.items()}

    def p(context, c):
        if not context:
            total = sum(v for g, v in value.items() if len(g) == 1)
            floor = L.DISCOUNT * sum(len(g) == 1 for g in value) / total / 5000
            return max(value.get(c, 0) - L.DISCOUNT, 0) / total + floor if c in value else floor
        own = [g for g in value if len(g) == len(context) + 1 and g[:-1] == context]
        lower = p(context[1:], c)
        if not own:
            return lower
        total = sum(value[g] for g in own)
        return max(value.get(context + c, 0) - L.DISCOUNT, 0) / total + L.DISCOUNT * len(own) / total * lower

    for w in ("abra", "crab", "zebra", "b"):
        padded = edge + w + edge
        bits = sum(-np.log2(p(padded[max(0, j - L.ORDER + 1) : j], padded[j])) for j in range(1, len(padded)))
        assert np.isclose(word_scores([model], [w])[0, 0], bits)


def test_whole_documents_against_brute_force(spark):
    """Languages and bits of all rows, by models over dictionaries of the same documents."""
    docs = documents(spark, "/root/testdata/sf0.001")
    lot = F.shiftrightunsigned(F.xxhash64(F.lit("lot"), "doc_id", "text"), 11) / F.lit(float(1 << 53))
    learned = docs.filter(fold() != 1).filter("text IS NOT NULL AND lang IS NOT NULL").filter(lot < L.SAMPLE / (L.SAMPLE + L.CALIBRATE)).collect()
    value, total, kinds = {}, {}, {}
    for lang in sorted({r["lang"] for r in learned}):
        seen, left = Counter(), {}
        for w in (w for r in learned if r["lang"] == lang for w in words_of(r["text"])):
            padded = chr(L.EDGE) + w + chr(L.EDGE)
            for k in range(1, L.ORDER + 1):
                for j in range(max(k - 1, 1), len(padded)):
                    seen[padded[j - k + 1 : j + 1]] += 1
        for g in seen:
            left.setdefault(g[1:], set()).add(g[0])
        own = value[lang] = {g: n if len(g) == L.ORDER or g not in left else len(left[g]) for g, n in seen.items()}
        total[lang], kinds[lang] = Counter(), Counter()
        for g, v in own.items():
            total[lang][g[:-1]] += v
            kinds[lang][g[:-1]] += 1

    @functools.cache
    def p(lang, context, c):
        n = total[lang][context]
        seen = max(value[lang].get(context + c, 0) - L.DISCOUNT, 0) / n if n else 0.0
        if not context:
            return seen + L.DISCOUNT * kinds[lang][""] / n / 5000
        return seen + (L.DISCOUNT * kinds[lang][context] / n if n else 1.0) * p(lang, context[1:], c)

    @functools.cache
    def bits(lang, w):
        padded = chr(L.EDGE) + w + chr(L.EDGE)
        return sum(-math.log2(p(lang, padded[max(0, j - L.ORDER + 1) : j], padded[j])) for j in range(1, len(padded)))

    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in identify(docs).collect():
        found = words_of(text[r["doc_id"]] or "")
        if not found:
            assert r["lang_pred"] == "und"
            continue
        n = sum(len(w) + 1 for w in found)
        each = {lang: sum(bits(lang, w) for w in found) / n for lang in value}
        assert math.isclose(r["bits"], min(each.values()), rel_tol=1e-9) and math.isclose(each[r["lang_pred"]], min(each.values()), rel_tol=1e-9)
        gaps = [min((x - min(each.values())) * math.sqrt(n), 500) for x in each.values()]
        assert math.isclose(r["score"], 1 / sum(2**-g for g in gaps), rel_tol=1e-6)


def test_messy_rows(messy):
    got = identify(messy).collect()
    assert len(got) == len(messy_rows())
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 and by[i]["rejected"] for i in (5, 6, 7))
    assert all(r["lang_pred"] in ("en", "de", "fr", "und") for r in got)
    assert accepted(messy).schema == messy.schema


def test_noise_is_rejected_and_prose_kept(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    rnd = random.Random(3)
    noise = [(10_000 + k, " ".join("".join(rnd.choices("qxzjkvwyp", k=9)) for _ in range(60)), None, "s") for k in range(20)]
    both = docs.select("doc_id", "text", "lang", "source").union(spark.createDataFrame(noise, "doc_id long, text string, lang string, source string"))
    left = {r[0] for r in accepted(both).select("doc_id").collect()}
    assert not any(i >= 10_000 for i in left) and len(left) >= 0.98 * docs.count()


FOREIGN = {
    "pl": "wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa",
    "fi": "kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto ja heidän on toimittava toisiaan kohtaan veljeyden hengessä",
    "tr": "bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler",
}


def test_foreign_passages_and_common_letters_are_rejected(spark):
    """Texts of 5 to 50 words in no learned language go, and parts of documents of the same lengths stay."""
    docs = documents(spark, "/root/testdata/sf0.01").filter("lang IS NOT NULL").select("doc_id", "text", "lang", "source")
    rnd = random.Random(4)
    rows, odd = [], 10**9
    for n in (5, 10, 20, 50):
        rows += [(odd + 100 * n + k, " ".join("".join(rnd.choices("etaoinshrdlu", k=rnd.randint(3, 9))) for _ in range(n)), None, "s") for k in range(25)]
        rows += [(odd + 100 * n + 50 + k, " ".join((t.split() * 3)[:n]), None, "s") for k, t in enumerate(FOREIGN.values())]
    parts = docs.orderBy("doc_id").limit(400).collect()
    rows += [(2 * odd + k, " ".join(r["text"].split()[: (5, 10, 20, 50)[k % 4]]), None, "s") for k, r in enumerate(parts) if r["text"]]
    got = {r["doc_id"]: r["rejected"] for r in identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), docs).collect()}
    gone = {n: [x for i, x in got.items() if i < 2 * odd and (i - odd) // 100 == n] for n in (5, 10, 20, 50)}
    share = {n: sum(x) / len(x) for n, x in gone.items()}
    kept = [not x for i, x in got.items() if i >= 2 * odd]
    assert share[50] == 1 and share[20] == 1 and share[10] >= 0.95 and share[5] >= 0.8
    assert sum(kept) >= 0.98 * len(kept)


def test_many_and_small_languages(spark):
    """No number of languages is too large, and one with a single row is known, too, without taking the noise."""
    docs = documents(spark, "/root/testdata/sf0.01").filter("lang IS NOT NULL").select("doc_id", "text", "lang", "source")
    tiny = [(10**6 + k, " ".join("".join(chr(0x4E00 + 30 * k + (7 * j + i) % 30) for i in range(4)) for j in range(40)), f"t{k}", "s") for k in range(8)]
    fitted = train(docs.union(spark.createDataFrame(tiny, "doc_id long, text string, lang string, source string")))
    assert {f"t{k}" for k in range(8)} <= set(fitted.languages) and len(fitted.languages) == 8 + docs.select("lang").distinct().count()
    assert all(np.isfinite(m.highest).all() for m in fitted.models)


def test_few_rows_are_split_like_many(spark):
    """29, 30 and 31 rows of a language: those of a low lot teach, whatever the number, and one row always does."""
    lot = F.shiftrightunsigned(F.xxhash64(F.lit("lot"), "doc_id", "text"), 11) / F.lit(float(1 << 53))
    for n in (1, 29, 30, 31):
        docs = spark.createDataFrame([(k, f"wort{k} haus{k % 3} baum", "de") for k in range(n)], "doc_id long, text string, lang string")
        own = docs.withColumn("lot", lot).collect()
        low = min(r["lot"] for r in own)
        learned = [r["text"] for r in own if r["lot"] < L.SAMPLE / (L.SAMPLE + L.CALIBRATE) or r["lot"] == low]
        fitted = train(docs)
        assert fitted.languages == ["de"] and 0 < len(learned) <= n
        direct = L.models_of(gram_counts(spark.createDataFrame([("de", t) for t in learned], "lang string, text string")))[1][0]
        assert all((a == b).all() for a, b in zip(fitted.models[0].grams, direct.grams)) and all(np.allclose(a, b) for a, b in zip(fitted.models[0].probability, direct.probability))


def test_runs_of_letters_of_any_length(spark):
    """An unspaced script: a run is one word, scored as a whole, also beside short ones and beyond a grid's cells."""
    rnd = random.Random(8)
    signs = [chr(0x4E00 + k) for k in range(60)]
    texts = ["".join(rnd.choices(signs, k=n)) for n in (3, 39, 40, 41, 200, 3000)] + ["kurz wort"]
    languages, (model,) = L.models_of(gram_counts(spark.createDataFrame([("zh", t) for t in texts], "lang string, text string")))
    whole = word_scores([model], [w for t in texts for w in words_of(t)])[:, 0]
    alone = [word_scores([model], [w])[0, 0] for t in texts for w in words_of(t)]
    assert np.allclose(whole, alone) and len(words_of(texts[5])) == 1
    old, L.CELLS = L.CELLS, 100
    try:
        assert np.allclose(word_scores([model], [w for t in texts for w in words_of(t)])[:, 0], whole)
    finally:
        L.CELLS = old
    seen = [chr(L.EDGE) + w + chr(L.EDGE) for t in texts for w in words_of(t)]
    grams = {s[j - 4 : j + 1] for s in seen for j in range(4, len(s))}
    assert len(model.grams[4]) == len(grams)  # none holds an edge inside a run


def test_nothing_to_read_or_learn_from(spark, nothing):
    assert identify(nothing).count() == 0 and accepted(nothing).count() == 0
    bare = frame(spark, [(1, "some text", None, "a")])
    assert train(bare).languages == []
    assert identify(bare).first()["lang_pred"] == "und" and accepted(bare).count() == 1
