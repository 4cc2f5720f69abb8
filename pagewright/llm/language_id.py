"""Language identification by interpolated Kneser-Ney character models.

A model scores the letters of a word given up to four characters before them in
the word, with the word's start as context, so a word's cross-entropy is known
once the word is. Words that a worker has scored are kept.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, worker_cache, written

#: Longest n-gram.
ORDER = 5
#: Labelled documents a language that are learned from, and that calibrate rejection, about (a hash of each row picks
#: them, and they are taken whole). Nothing else bounds the models, which hold every n-gram of these.
SAMPLE = 4000
CALIBRATE = 2000
#: Kneser-Ney's discount.
DISCOUNT = 0.75
#: Scores of so many words, and of words of so many letters in all, are kept by a Python worker.
WORDS = 250_000
LETTERS = 4_000_000
#: Words that are hashed together fill so many cells at most, or are one word.
CELLS = 1 << 20
#: A text is rejected if its cross-entropy is over this quantile of its language's, for passages of its length.
QUANTILE = 0.999
#: Lengths, in characters, at which that is calibrated; passages of each that a document gives at most.
BANDS = np.unique((2 * 1.5 ** np.arange(22)).astype(int))
PASSAGES = 4

EDGE = 1
_LETTERS = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased, of any length."""
    return _LETTERS(text.lower())


def _alike(words: list[str], most: int) -> Iterator[np.ndarray]:
    """Numbers of ``words`` by length, ``most`` or CELLS cells of a grid at a time; a longer word is alone."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    by, at = np.argsort(lengths, kind="stable"), 0
    while at < len(by):
        end = min(at + most, len(by))
        while end - at > 1 and (end - at) * (lengths[by[end - 1]] + 2) > CELLS:
            end = at + (end - at) // 2
        yield by[at:end]
        at = end


def _grid(words: list[str]) -> np.ndarray:
    """Code points of EDGE + word + EDGE in rows, 0 beyond."""
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    grid = np.zeros((len(words), int(lengths.max(initial=0)) + 2), dtype=np.uint64)
    inside = np.arange(grid.shape[1] - 2) < lengths[:, None]
    grid[:, 1:-1][inside] = points
    grid[:, 0] = EDGE
    grid[np.arange(len(words)), lengths + 1] = EDGE
    return grid


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def gram_hashes(grid: np.ndarray, order: int) -> np.ndarray:
    """At [i, j] the hash of the ``order`` characters of row i that end in column j; 0 where there are none."""
    out = np.zeros(grid.shape, dtype=np.uint64)
    wide = grid.shape[1] - order + 1
    if wide <= 0:
        return out
    value = np.full((grid.shape[0], wide), order, dtype=np.uint64)
    for k in range(order):
        value = _mix(value * np.uint64(0x100000001B3) + grid[:, k : k + wide])
    value[(grid[:, order - 1 : order - 1 + wide] == 0)] = 0
    out[:, order - 1 :] = value
    return out


def _count(order: int):
    """For batches of (lang, text): how often each n-gram occurs, as signed hashes: lang, k, gram, context, rest, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[str, int]] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts = held.setdefault(lang, {})
                for w in words_of(text):
                    counts[w] = counts.get(w, 0) + 1
            if sum(map(len, held.values())) > 100_000:
                for lang, counts in held.items():
                    yield from _grams(lang, counts, order)
                held = {}
        for lang, counts in held.items():
            yield from _grams(lang, counts, order)

    return run


def _grams(lang: str, counts: dict[str, int], order: int) -> Iterator[pa.RecordBatch]:
    words, times = list(counts), np.fromiter(counts.values(), dtype=np.int64)
    for part in _alike(words, 20_000):
        grid = _grid([words[i] for i in part])
        n = times[part]
        hashes = [gram_hashes(grid, k) for k in range(1, order + 1)]
        for k in range(1, order + 1):
            own = hashes[k - 1]
            context = np.zeros_like(own)
            rest = np.zeros_like(own)
            if k > 1:
                context[:, 1:] = hashes[k - 2][:, :-1]  # without the last character
                rest = hashes[k - 2]  # without the first
            use = own != 0
            use[:, 0] = False  # the edge at a word's start is context only
            repeated = np.broadcast_to(n[:, None], own.shape)[use]
            grams, first, back = np.unique(own[use], return_index=True, return_inverse=True)
            total = np.bincount(back, weights=repeated).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(np.full(len(grams), k, np.int32)), pa.array(grams.view(np.int64)), pa.array(context[use][first].view(np.int64)), pa.array(rest[use][first].view(np.int64)), pa.array(total)],
                names=["lang", "k", "gram", "context", "rest", "n"],
            )


def gram_counts(sample: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of all n-grams of (lang, text), summed over the cluster, with Kneser-Ney's counts of distinct left neighbours below the highest order."""
    kinds = "lang string, k int, gram long, context long, rest long, n long"
    counted = written(sample.mapInArrow(_count(order), kinds).groupBy("lang", "k", "gram").agg(F.first("context").alias("context"), F.first("rest").alias("rest"), F.sum("n").alias("n")), "grams")
    left = counted.filter("k > 1").groupBy("lang", (F.col("k") - 1).alias("k"), F.col("rest").alias("gram")).agg(F.count("*").alias("kinds"))
    joined = counted.join(left, ["lang", "k", "gram"], "left")
    # a gram at a word's start has no left neighbour: its own count stands
    return joined.withColumn("value", F.when(F.col("k") == order, F.col("n")).otherwise(F.coalesce("kinds", "n")).cast("long")).select("lang", "k", "gram", "context", "n", "value")


@dataclass
class Model:
    """Of one language: for each order, sorted hashes with log-free probabilities, and sorted context hashes with backoff weights."""

    grams: list[np.ndarray] = field(default_factory=list)
    probability: list[np.ndarray] = field(default_factory=list)
    contexts: list[np.ndarray] = field(default_factory=list)
    backoff: list[np.ndarray] = field(default_factory=list)
    floor: float = 1e-6
    #: The highest usual cross-entropy at each of BANDS; without calibration nothing is unusual.
    highest: np.ndarray = field(default_factory=lambda: np.full(len(BANDS), np.inf))


def gram_weights(counts: DataFrame) -> DataFrame:
    """``counts`` of n-grams as lang, k, gram, context, probability, backoff (of the context), floor (of a character that is not known)."""
    of = W.partitionBy("lang", "k", "context")  # followers of one context are as many as there are characters; a single letter has no context
    total, kinds = F.greatest(F.sum("value").over(of), F.lit(1)), F.count("*").over(of)
    # the discount's mass over unseen characters
    floor = F.when(F.col("k") == 1, F.lit(DISCOUNT) * kinds / total / 5000).otherwise(0.0)
    seen = F.greatest(F.col("value") - F.lit(DISCOUNT), F.lit(0.0)) / total + floor
    return counts.select("lang", "k", "gram", "context", seen.alias("probability"), (F.lit(DISCOUNT) * kinds / total).alias("backoff"), floor.alias("floor"))


def _pack(table: pa.Table) -> pa.Table:
    """One order of one language as sorted arrays of bytes."""
    gram, context, probability, backoff = (table.column(c).to_numpy() for c in ("gram", "context", "probability", "backoff"))
    by = np.argsort(gram)
    contexts, first = np.unique(context, return_index=True)
    arrays = (gram[by], probability[by], contexts, backoff[first])
    return pa.table({"lang": table.column("lang")[:1], "k": table.column("k")[:1], **{f"a{i}": pa.array([a.tobytes()], pa.binary()) for i, a in enumerate(arrays)}, "floor": table.column("floor")[:1]})


def models_of(counts: DataFrame) -> tuple[list[str], list[Model]]:
    """The languages of ``counts`` and their models.

    Tasks build the sorted arrays, one an order of a language, which hold no more
    than SAMPLE documents do. Only those come to the driver, to be broadcast.
    """
    packed = written(gram_weights(counts).groupBy("lang", "k").applyInArrow(_pack, "lang string, k int, a0 binary, a1 binary, a2 binary, a3 binary, floor double"), "models")
    models: dict[str, Model] = {}
    for r in packed.orderBy("lang", "k").toLocalIterator():
        model = models.setdefault(r["lang"], Model())
        grams, probability, contexts, backoff = (np.frombuffer(r[f"a{i}"], kind) for i, kind in enumerate(("<i8", "<f8", "<i8", "<f8")))
        model.grams.append(grams)
        model.probability.append(probability)
        if r["k"] == 1:
            model.floor = r["floor"]
        else:
            model.contexts.append(contexts)
            model.backoff.append(backoff)
    for model in models.values():  # texts of short words lack the longest n-grams
        while len(model.grams) < ORDER:
            model.grams.append(np.zeros(0, "<i8"))
            model.probability.append(np.zeros(0))
            model.contexts.append(np.zeros(0, "<i8"))
            model.backoff.append(np.zeros(0))
    return list(models), list(models.values())


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(wanted.shape, missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def word_scores(models: list[Model], words: list[str], order: int = ORDER) -> np.ndarray:
    """Bits of each word (its letters and its end) by each model."""
    out = np.zeros((len(words), len(models)))
    for part in _alike(words, 4096):
        grid = _grid([words[i] for i in part])
        hashes = [gram_hashes(grid, k)[:, 1:] for k in range(1, order + 1)]
        inside = hashes[0] != 0
        flat = [h[inside] for h in hashes]
        before = [np.zeros_like(flat[0])] + [gram_hashes(grid, k)[:, :-1][inside] for k in range(1, order)]
        row = np.broadcast_to(np.arange(len(part))[:, None], inside.shape)[inside]
        for m, model in enumerate(models):
            p = _look(model.grams[0], model.probability[0], flat[0].view(np.int64), model.floor)
            for k in range(2, order + 1):
                has = flat[k - 1] != 0
                context = before[k - 1].view(np.int64)
                share = np.where(has, _look(model.contexts[k - 2], model.backoff[k - 2], context, 1.0), 1.0)
                seen = np.where(has, _look(model.grams[k - 1], model.probability[k - 1], flat[k - 1].view(np.int64), 0.0), 0.0)
                p = seen + share * p
            out[part, m] = np.bincount(row, weights=-np.log2(p), minlength=len(part))
    return out


class Scorer:
    """Cross-entropies of texts by all models, in bits a character, and the number of characters."""

    def __init__(self, models: list[Model]) -> None:
        self.models, self.kept, self.letters = models, {}, 0
        self.table = np.zeros((0, len(models)))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [words_of(t) for t in texts]
        if len(self.kept) > WORDS or self.letters > LETTERS:
            self.kept, self.letters, self.table = {}, 0, np.zeros((0, len(self.models)))
        kept = self.kept
        new = list({w for ws in found for w in ws if w not in kept})
        if new:
            start = len(kept)
            self.letters += sum(map(len, new))
            kept.update(zip(new, range(start, start + len(new)), strict=True))
            self.table = np.concatenate([self.table, word_scores(self.models, new)])
        counts = np.array([len(ws) for ws in found])
        rows = np.fromiter((kept[w] for ws in found for w in ws), dtype=np.int64, count=int(counts.sum()))
        doc = np.repeat(np.arange(len(texts)), counts)
        bits = np.stack([np.bincount(doc, weights=self.table[rows, m], minlength=len(texts)) for m in range(len(self.models))], axis=1)
        characters = np.array([sum(map(len, ws)) + len(ws) for ws in found], dtype=float)
        return bits / np.maximum(characters, 1)[:, None], characters


@dataclass
class LanguageModels:
    """Sorted by language; ``models`` and their calibration fit together."""

    languages: list[str]
    models: list[Model]

    def scorer(self) -> Scorer:
        """One for this Python worker, as long as it works with these models."""
        kept = worker_cache("languages")
        if kept.get("models") is not self.models:
            kept.clear()
            kept |= {"models": self.models, "scorer": Scorer(self.models)}
        return kept["scorer"]


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of doc_id as text, modulo 3 (null: 0)."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)), F.lit(0)).cast("int")


def train(labelled: DataFrame, sample: int = SAMPLE, calibrate: int = CALIBRATE) -> LanguageModels:
    """Models of all languages of ``labelled`` (doc_id, text, lang).

    About ``sample`` documents a language are learned from and ``calibrate`` more
    set its highest usual cross-entropy for each length; the lot of each row, a hash of it, decides
    which, and they are taken whole. The lowest lot of a language always teaches, so a
    language of one row is known; one without a row to calibrate with is held to the
    highest bounds of the others. Null texts and null languages are left out.
    """
    lot = F.shiftrightunsigned(F.xxhash64(F.lit("lot"), "doc_id", "text"), 11) / F.lit(float(1 << 53))
    rows = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("doc_id", "text", "lang").withColumn("lot", lot)
    sizes = written(rows.groupBy("lang").agg(F.count("*").alias("rows"), F.min("lot").alias("lowest")), "languages")
    share = F.least(F.lit(1.0), F.lit(float(sample + calibrate)) / F.col("rows"))
    learns = (F.col("lot") < F.col("share") * (sample / (sample + calibrate))) | (F.col("lot") == F.col("lowest"))
    picked = rows.join(sizes, "lang").withColumn("share", share).filter((F.col("lot") < F.col("share")) | (F.col("lot") == F.col("lowest"))).withColumn("learns", learns)
    picked = written(picked.select("doc_id", "lang", "text", "learns"), "sample")
    languages, models = models_of(gram_counts(picked.filter("learns").select("lang", "text")))
    out = LanguageModels(languages, models)
    if not models:
        return out
    passages = _passages(picked.filter(~F.col("learns") & F.col("lang").isin(languages)).select("lang", "text"), out)
    bounds = passages.groupBy("lang", "band").agg(F.percentile("bits", F.lit(QUANTILE)).alias("high"), F.percentile("bits", F.lit(0.5)).alias("usual"), F.sum("first").alias("docs"))
    for r in bounds.collect():  # a row a language and length
        # the highest of few documents is below the quantile of many
        models[languages.index(r["lang"])].highest[r["band"]] = r["high"] + 2 / math.sqrt(r["docs"]) * max(r["high"] - r["usual"], 1.0)
    for model in models:
        for k in range(1, len(BANDS)):  # longer than all that was calibrated
            if math.isinf(model.highest[k]):
                model.highest[k] = model.highest[k - 1]
    known = [m.highest for m in models if not math.isinf(m.highest[0])]
    for model in models:  # languages without a held-out document
        if known and math.isinf(model.highest[0]):
            model.highest = np.max(known, axis=0)
    return out


def _passages(docs: DataFrame, fitted: LanguageModels) -> DataFrame:
    """Of documents (lang, text) that their own model fits best, passages of each of BANDS: lang, band, bits a character, and 1 for a document's first of the band, else 0."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models: LanguageModels = sent.value
        scorer = models.scorer()
        for batch in batches:
            rows = []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                entropy, characters = scorer([text])
                own = models.languages.index(lang)
                if not characters[0] or entropy[0].argmin() != own:
                    continue
                words = words_of(text)
                bits = np.concatenate([[0.0], np.cumsum(scorer.table[[scorer.kept[w] for w in words], own])])
                size = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
                for band, length in enumerate(BANDS):
                    last = np.searchsorted(size, size[-1] - length, "right") - 1  # the last word that so many characters follow from
                    if last < 0:
                        break
                    starts = np.unique(np.linspace(0, last, PASSAGES).astype(int))
                    ends = np.searchsorted(size, size[starts] + length)
                    passed = (bits[ends] - bits[starts]) / (size[ends] - size[starts])
                    rows += [(lang, band, x, int(not k)) for k, x in enumerate(passed.tolist())]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.float64(), pa.int32()), strict=True)], names=["lang", "band", "bits", "first"])

    return docs.mapInArrow(run, "lang string, band int, bits double, first int")


def _excess(fitted: LanguageModels, entropy: np.ndarray, characters: np.ndarray) -> np.ndarray:
    """Bits a character by which the best language's cross-entropy lies over the highest that is usual for it at that length."""
    best = entropy.argmin(axis=1)
    band = np.maximum(np.searchsorted(BANDS, characters, "right") - 1, 0)
    return entropy.min(axis=1) - np.stack([m.highest for m in fitted.models])[best, band]


def _scoring(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: LanguageModels = sent.value
        scorer = fitted.scorer()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = batch.column("text").to_pylist()
                n = len(texts)
                pred, bits, confidence, excess, characters = ["und"] * n, np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
                if fitted.models:
                    entropy, characters = scorer(texts)
                    best = entropy.argmin(axis=1)
                    bits = entropy[np.arange(n), best]
                    # the posterior of the best language, by a length that grows slower than the text
                    gap = (entropy - bits[:, None]) * np.sqrt(np.maximum(characters, 1))[:, None]
                    confidence = 1 / np.exp2(-np.minimum(gap, 500)).sum(axis=1)
                    excess = _excess(fitted, entropy, characters)
                    pred = [fitted.languages[b] if c else "und" for b, c in zip(best, characters, strict=True)]
                    confidence = np.where(characters > 0, confidence, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"), pa.array(pred, pa.string()), pa.array(confidence), pa.array(bits), pa.array(characters), pa.array(excess)],
                    names=[*(x for x in batch.schema.names if x != "text"), "lang_pred", "score", "bits", "characters", "excess"],
                )

    return run


def score(docs: DataFrame, fitted: LanguageModels, keep: str | None = None) -> DataFrame:
    """doc_id (and ``keep``), lang_pred, score, bits a character, characters, excess of each row, from its text alone."""
    rows = docs.select("doc_id", *([keep] if keep else []), text_or_empty().alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != "text")
    sent = docs.sparkSession.sparkContext.broadcast(fitted)
    return rows.mapInArrow(_scoring(sent), f"{kinds}, lang_pred string, score double, bits double, characters double, excess double")


def identify(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """The language of every row of ``docs``: the one whose model needs the fewest bits a character.

    Models learn from ``labelled``, or else from the rows of ``docs`` with a
    non-null lang whose ``fold`` is not 1. ``score`` is the posterior of the
    language, 0 for ``und``: a null text, one without letters, or nothing to learn
    from. ``rejected`` marks ``und`` and texts whose cross-entropy lies over the
    QUANTILE of what passages of their length have in held-out documents of their language.
    Repeated rows each get a row; other columns are not read.

    Returns doc_id, held_out, lang_pred, score, bits, rejected.
    """
    fitted = train(docs.filter(fold() != 1) if labelled is None else labelled)
    scored = score(docs, fitted)
    rejected = (F.col("lang_pred") == "und") | (F.col("excess") > 0)
    return scored.select("doc_id", (fold() == 1).alias("held_out"), "lang_pred", "score", "bits", rejected.alias("rejected"))


def _accepting(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted: LanguageModels = sent.value
        scorer = fitted.scorer()
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                texts = [t or "" for t in batch.column("text").to_pylist()]
                if fitted.models:
                    entropy, characters = scorer(texts)
                    keep = (characters > 0) & (_excess(fitted, entropy, characters) <= 0)
                    batch = batch.filter(pa.array(keep))
                yield batch

    return run


def accepted(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """``docs`` with all columns, without the rows that ``identify`` rejects. With nothing to learn from, all rows stay."""
    fitted = train(docs.filter(fold() != 1) if labelled is None else labelled)
    return docs.mapInArrow(_accepting(docs.sparkSession.sparkContext.broadcast(fitted)), docs.schema)
