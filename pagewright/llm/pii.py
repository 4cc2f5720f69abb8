"""Personal data by fixed forms, and by contexts that the found ones teach.

What the four base forms match, and identifiers that a user knows already, seed a
graph of patterns (the words on the left, on the right or on both sides of an
identifier) and instances (what looks like an identifier, of whatever form). Belief
flows between the two by rounds of joins, until no further pattern is known; patterns
that keep company mostly with believed identifiers add spans of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.shared import text_or_empty, unused, written

#: Kinds in the order in which spans that start together are listed; added spans come last.
KINDS = ("email", "ip", "card", "phone", "context")
#: A pattern is known from this confidence and this support by distinct believed identifiers on.
CONFIDENCE = 0.9
SUPPORT = 3
#: Shorter tokens, and shorter runs of tokens, are no identifiers.
SHORTEST = 6
#: At most so many identifiers are given as seeds: they go to every task.
SEEDS = 100_000

# fixed values: the base forms
EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGITS = re.compile(r"[0-9]").search
_TOKEN = re.compile(r"[^\s=]+=*(?=\s|$)|[^\s=]+|=+")
_TRIM = ".,;:!?\"'()[]{}<>|#$%&*="


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, in time linear in the text."""
    found, at, free = [], text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := EMAIL_DOMAIN.match(text, at + 1)):
            found.append((start, domain.end()))
            free = domain.end()
        else:
            free = at + 1
        at = text.find("@", free)
    return found


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """All base matches, by start, then kind."""
    found = [("email", *span) for span in emails(text)] if "@" in text else []
    if _DIGITS(text):
        # a run of digits that begins no address does so at none of its digits
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
        if "+" in text:
            found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _pattern(kind: str, *words: str) -> int | None:
    """A hash of the words of a context; none, where there are none."""
    return xxhash.xxh64_intdigest("\0".join((kind, *words))) - (1 << 63) if any(words) else None


def _word(token: str) -> str:
    return re.sub(r"[0-9]", "9", (token.strip(_TRIM) or token).lower())


class _Candidates:
    """Identifiers of one text, known or likely, with their contexts."""

    def __init__(self, text: str, seeds: frozenset[str]) -> None:
        self.text, self.seeds, self.found = text, seeds, []
        self.tokens = [m.span() for m in _TOKEN.finditer(text)]
        self.words = [_word(text[s:e]) for s, e in self.tokens]

    def add(self, start: int, end: int, first: int, last: int, run: int, whole: bool, kind: str) -> None:
        """Adds text[start:end], which lies in the tokens first to last."""
        text, words = self.text[start:end], self.words
        left = [words[k] if k >= 0 else "" for k in (first - 2, first - 1)]
        right = [words[k] if k < len(words) else "" for k in (last + 1, last + 2)]
        # what a token has beside a base match is its nearest context
        head, tail = self.text[self.tokens[first][0] : start].strip(_TRIM), self.text[end : self.tokens[last][1]].strip(_TRIM)
        if head:
            left = [left[1], _word(head)]
        if tail:
            right = [_word(tail), right[0]]
        patterns = {_pattern("l", *left), _pattern("r", *right), _pattern("b", left[1], right[0])} - {None}
        if patterns:
            seed = bool(kind) or text in self.seeds
            self.found.append((start, end, run, whole, sorted(patterns), xxhash.xxh64_intdigest(text) - (1 << 63), kind, seed))

    def add_run(self, cores: list[tuple[int, int, int]]) -> None:
        """Adds neighbouring tokens (number, start, end), each and as a whole."""
        run = cores[0][1]
        if len(cores) > 1 and cores[-1][2] - run >= SHORTEST:
            self.add(run, cores[-1][2], cores[0][0], cores[-1][0], run, True, "")
        for k, start, end in cores:
            if end - start >= SHORTEST and _like(self.text[start:end]):
                self.add(start, end, k, k, run, len(cores) == 1, "")


def _like(core: str) -> bool:
    return bool(_DIGITS(core)) or "@" in core


def candidates(text: str, spans: list[tuple[str, int, int]], seeds: frozenset[str] = frozenset()) -> list[tuple[int, int, int, bool, list[int], int, str, bool]]:
    """Base spans, and what looks like an identifier: start, end, its run, whether it is all of the run, patterns, instance, the base kind or "", whether it is a seed.

    Tokens with a digit or an at sign look like identifiers, and so do runs of them
    that only white space parts, with words in capitals between two of them.
    """
    if not _like(text):
        return []
    own = _Candidates(text, seeds)
    tokens, k, j, taken = own.tokens, 0, 0, 0
    for kind, s, e in spans:
        if s >= taken:
            while tokens[k][1] <= s:
                k += 1
            j = max(j, k)
            while tokens[j][1] < e:
                j += 1
            own.add(s, e, k, j, s, True, kind)
            taken = e
    k, run, caps = 0, [], []
    ends = list(accumulate((e for _, _, e in spans), max))
    for i, (start, end) in enumerate(tokens):
        while k < len(spans) and ends[k] <= start:
            k += 1
        token = text[start:end]
        core = token.strip(_TRIM)
        s = start + token.find(core)
        if run and s > start:  # a sign before it
            own.add_run(run)
            run, caps = [], []
        if core and not (k < len(spans) and spans[k][1] < end):
            if _like(core):
                run, caps = [*run, *caps, (i, s, s + len(core))] if caps else run, []
                if not run or run[-1][0] != i:
                    run.append((i, s, s + len(core)))
            elif run and core.isupper():
                caps.append((i, s, s + len(core)))
            elif run:
                own.add_run(run)
                run, caps = [], []
            if run and s + len(core) < end:  # a sign after it
                own.add_run(run)
                run, caps = [], []
        elif run:
            own.add_run(run)
            run, caps = [], []
    if run:
        own.add_run(run)
    return own.found


_NEAR = [("start", pa.int64()), ("end", pa.int64()), ("run", pa.int64()), ("whole", pa.bool_()), ("patterns", pa.list_(pa.int64())), ("instance", pa.int64()), ("kind", pa.string()), ("seed", pa.bool_())]


def _scan(seeds: frozenset[str]):
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    names, kept = [name for name, _ in _NEAR], ["doc_id", "row", "text_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, more = [], []
            for text in batch.column("text"):
                t = text.as_py()
                found = base_spans(t)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in found])
                more.append([dict(zip(names, c, strict=True)) for c in candidates(t, found, seeds)])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(base, span), pa.array(more, pa.list_(pa.struct(_NEAR)))], names=[*kept, "base", "near"])

    return run


def scan(docs: DataFrame, seeds: Iterable[str] = ()) -> DataFrame:
    """For each row: doc_id, a number, a digest of its text, its base spans, and its candidates with their patterns."""
    given = frozenset(seeds)
    if len(given) > SEEDS:
        raise ValueError(f"at most {SEEDS} identifiers can be given as seeds")
    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumns({"row": F.monotonically_increasing_id(), "text_sha256": F.sha2("text", 256)})
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        _scan(given),
        f"doc_id {kind}, row long, text_sha256 string, base array<struct<kind:string,start:long,end:long>>,"
        " near array<struct<start:long,end:long,run:long,whole:boolean,patterns:array<long>,instance:long,kind:string,seed:boolean>>",
    )


def learn_patterns(found: DataFrame) -> DataFrame:
    """The patterns that are known for identifiers: pattern, confidence, support.

    Seeds are believed from the start. A pattern's support is the sum of
    its instances' beliefs, each counted once, and its confidence their average.
    From CONFIDENCE and SUPPORT on it is known, and its other instances are
    believed as much as it was then, so that they can make further patterns
    known. Rounds go on until one makes no pattern known.
    """
    near = found.select(F.explode("near").alias("n")).select("n.instance", "n.seed", F.explode("n.patterns").alias("pattern"))
    edges = near.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    edges = written(edges, "edges")
    beliefs = written(edges.filter("seed").select("instance", F.lit(1.0).alias("belief")).distinct(), "beliefs")
    # no belief is over 1, so patterns of fewer instances never have the support
    sizes = edges.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") >= SUPPORT)
    edges = written(edges.join(sizes, "pattern").select("pattern", "instance", "n"), "edges")
    known = None
    while True:
        scored = edges.join(beliefs, "instance").groupBy("pattern").agg(F.sum("belief").alias("support"), F.first("n").alias("n"))
        good = scored.select("pattern", (F.col("support") / F.col("n")).alias("confidence"), "support").filter((F.col("confidence") >= CONFIDENCE) & (F.col("support") >= SUPPORT))
        fresh = written(good if known is None else good.join(known, "pattern", "left_anti"), "patterns")
        known = fresh if known is None else known.unionByName(fresh)
        if fresh.isEmpty():
            return known
        learned = edges.join(fresh, "pattern").groupBy("instance").agg(F.max("confidence").alias("belief"))
        beliefs = written(beliefs.unionByName(learned).groupBy("instance").agg(F.max("belief").alias("belief")), "beliefs")


def _listed(spans: str) -> Column:
    rank = f"array_position(array({', '.join(repr(k) for k in KINDS)}), s.kind)"
    ordered = f"array_sort(transform({spans}, s -> struct(s.start AS start, {rank} AS rank, s.end AS end, s.kind AS kind)))"
    return F.array_join(F.expr(f"transform({ordered}, s -> concat(s.kind, ':', s.start, ':', s.end))"), ",")


def find_personal_data(docs: DataFrame, seeds: Iterable[str] = ()) -> DataFrame:
    """The personal data of every row of ``docs``; a null text is empty and has none.

    ``seeds`` are identifiers known already, at most SEEDS; they teach contexts as base
    matches do, and are themselves found only in known contexts.
    Base spans always stay. What looks like an identifier and lies in a known
    context (see learn_patterns) adds a span of kind ``context``; of a run of
    tokens, the whole if it does, else those of its tokens that do. Repeated rows
    each get a row; other columns are not read; an empty table gives an empty result.

    Returns doc_id, n_email, n_ip, n_card, n_phone, n_context, n_spans, base_sha256,
    spans, text_sha256 (of the text, by which redact finds the spans).
    """
    found = written(scan(docs, seeds), "found")
    good = learn_patterns(found).select("pattern")
    fresh = found.select("row", F.explode("near").alias("n")).filter("n.kind = ''").select("row", "n.*").withColumn("pattern", F.explode("patterns")).join(good, "pattern", "left_semi")
    runs = fresh.groupBy("row", "run").agg(F.collect_set(F.struct(F.lit("context").alias("kind"), "start", "end", "whole")).alias("all"))
    spans = runs.select("row", F.expr("transform(filter(all, s -> s.whole OR NOT exists(all, t -> t.whole)), s -> struct(s.kind, s.start, s.end))").alias("spans"))
    added = spans.groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("added"))
    rows = found.drop("near").join(added, "row", "left").withColumn("all", F.expr("concat(base, coalesce(added, array()))"))
    count = {f"n_{k}": F.expr(f"CAST(size(filter(all, s -> s.kind = '{k}')) AS long)") for k in KINDS}
    every = F.size("all").cast("long").alias("n_spans")
    return rows.select("doc_id", *(c.alias(n) for n, c in count.items()), every, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed("all").alias("spans"), "text_sha256")


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with each span of ``found`` (see find_personal_data) replaced by its kind in angle brackets.

    Spans belong to a text, whatever row it is in, so null and repeated doc_id are
    no matter; a null text stays null. A text that ``found`` does not cover is an
    error: it must not go out as it is.
    """

    @F.pandas_udf("string")
    def cover(text, spans):
        import pandas as pd

        out = []
        for t, s in zip(text, spans, strict=True):
            if t is not None and s is None:
                raise ValueError("a text was not searched for personal data")
            if t is not None and s:
                cut, at = [], 0
                for kind, start, end in (x.split(":") for x in s.split(",")):
                    if int(start) >= at:
                        cut += [t[at : int(start)], f"<{kind}>"]
                    elif int(end) > at:
                        cut.append(f"<{kind}>")  # spans that overlap
                    at = max(at, int(end))
                t = "".join(cut) + t[at:]
            out.append(t)
        return pd.Series(out, dtype="object")

    digest, spans = unused(docs, "digest", "spans")
    known = found.groupBy(F.col("text_sha256").alias(digest)).agg(F.first("spans").alias(spans))
    keyed = docs.withColumn(digest, F.sha2(text_or_empty(), 256)).join(known, digest, "left")
    return keyed.withColumn("text", cover(F.col("text").cast("string"), F.col(spans))).select(*docs.columns)
