"""Secret scan with a trigram index.

From each rule's pattern follows a Boolean query: the trigrams that any match must hold. An inverted index lists the
texts that hold a trigram; its lists are intersected and united as the query says, and only the candidates are searched
with the pattern. A rule without mandatory trigrams is searched for in every text.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millstream.llm.sieve import keeper
from millstream.session import stored

#: A query is a trigram, ("and" or "or", queries) or ANY.
ANY = None
#: Most texts that a part of a pattern may stand for and still be spelled out.
MOST = 16


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern` are secrets where `group` (0: all of it) has `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    either_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.either_case else self.pattern


#: The words, prefixes and lengths are fixed values of the scan's contract.
BASE = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # a run of 24 or more is a match of [0-9a-f]+ that is kept, and the other way round
)


def _all(queries) -> object:
    found = sorted({q for q in queries if q is not ANY}, key=repr)
    return ANY if not found else found[0] if len(found) == 1 else ("and", tuple(found))


def _any(queries) -> object:
    queries = set(queries)
    plain = {q: {q} if isinstance(q, str) else set(q[1]) for q in queries if q is not ANY and q[0] != "or"}
    found = sorted((q for q in queries if not any(plain[o] < plain[q] for o in plain if q in plain)), key=repr)
    return ANY if not found or ANY in found else found[0] if len(found) == 1 else ("or", tuple(found))


def _spelled(texts: set[str]) -> object:
    """Query for a text that holds one of these."""
    return _any(_all({t[i : i + 3] for i in range(len(t) - 2)}) for t in texts)


def _of(parsed) -> tuple[set[str] | None, object]:
    """The texts that a part of a pattern stands for, if few, and otherwise its query."""
    queries, now = [], {""}
    for code, value in parsed:
        texts, query = _of_one(code, value)
        if texts is not None and len(now) * len(texts) <= MOST * 4:
            now = {a + b for a in now for b in texts}
        else:
            queries += [_spelled(now), query if texts is None else _spelled(texts)]
            now = {""}
    if not queries:
        return now, ANY
    return None, _all([*queries, _spelled(now)])


def _of_one(code, value) -> tuple[set[str] | None, object]:
    if code is op.LITERAL:
        return {chr(value).lower()}, ANY
    if code is op.AT:
        return {""}, ANY
    if code is op.IN and value[0][0] is not op.NEGATE:
        ranges = [(a, a) if c is op.LITERAL else a for c, a in value if c in (op.LITERAL, op.RANGE)]
        if len(ranges) == len(value) and sum(b - a + 1 for a, b in ranges) <= MOST:
            texts = {chr(x).lower() for a, b in ranges for x in range(a, b + 1)}
            return (texts, ANY) if len(texts) <= 4 else (None, ANY)
    if code is op.SUBPATTERN:
        return _of(value[-1])
    if code is op.BRANCH:
        parts = [_of(x) for x in value[1]]
        if all(t is not None for t, _ in parts):
            return set().union(*(t for t, _ in parts)), ANY
        return None, _any(q if t is None else _spelled(t) for t, q in parts)
    if code in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, part = value
        texts, query = _of(part)
        if texts is not None and (least, most) == (0, 1):
            return {""} | texts, ANY
        if texts is not None and least == most == 1:
            return texts, ANY
        return None, (query if texts is None else _spelled(texts)) if least else ANY
    return None, ANY


def trigram_query(pattern: str) -> object:
    """What trigrams, in lower case, a text must hold to match the pattern; ANY if none are mandatory."""
    texts, query = _of(_parser.parse(pattern))
    return query if texts is None else _spelled(texts)


def trigrams(query: object) -> set[str]:
    if query is ANY:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _holds(query: object, has: Callable[[str], Column]) -> Column:
    if isinstance(query, str):
        return has(query)
    return reduce(Column.__and__ if query[0] == "and" else Column.__or__, (_holds(q, has) for q in query[1]))


def _key(key: str, text: str) -> Column:
    return F.xxhash64(key, text)


def index(docs: DataFrame, wanted: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Inverted index (trigram, doc): a row for each of the wanted trigrams that a text holds, in either case.

    doc is a hash of key and text, so that rows which repeat both are one entry, and a hot key's texts many.
    """
    low = docs.select(_key(key, text).alias("doc"), F.lower(text).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted]))
    return low.select("doc", F.explode(found).alias("trigram")).select("trigram", "doc")


def candidates(postings: DataFrame, queries: dict[str, object]) -> DataFrame:
    """(doc, kinds): texts that meet the trigram query of at least one kind."""
    wanted = sorted(set().union(*map(trigrams, queries.values())))
    column = {t: f"t{i}" for i, t in enumerate(wanted)}
    rows = postings.groupBy("doc").agg(*[F.max(F.col("trigram") == t).alias(c) for t, c in column.items()])
    kinds = [F.when(_holds(q, lambda t: F.col(column[t])), F.lit(k)) for k, q in queries.items()]
    return rows.select("doc", F.array_compact(F.array(*kinds)).alias("kinds")).filter(F.size("kinds") > 0)


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """(start, place of the kind, end) of each secret, in code points, from the texts between matches and the matches."""
    pattern = F.lit(rule.java)
    between, found = F.split(text, rule.java, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    steps = F.arrays_zip(between.alias("b"), found.alias("f"), judged.alias("j"))
    empty = F.array().cast("array<struct<start:int,place:int,end:int>>")

    def add(state: Column, step: Column) -> Column:
        start = state["at"] + F.length(step["b"])
        end = start + F.length(step["f"])
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"))
        return F.struct(F.when(F.length(step["j"]) >= rule.least, F.concat(state["made"], F.array(span))).otherwise(state["made"]).alias("made"), end.alias("at"))

    state = F.struct(empty.alias("made"), F.lit(0).alias("at"))
    return F.aggregate(F.slice(steps, 1, F.size(found)), state, add, lambda s: s["made"])


def scan(docs: DataFrame, rules: Sequence[Rule] = BASE, key: str = "doc_id", text: str = "text", spans: str = "spans") -> DataFrame:
    """`docs` with `spans` (array of kind, start, end in code points, end exclusive; replaced if there).

    Per rule the leftmost matches that don't overlap, without those that are too short; by start, then by the order of
    the rules. A null text is empty and has none. Whole texts are searched, repeated rows each, and other columns pass
    unchanged.
    """
    queries = {r.kind: trigram_query(f"(?i:{r.pattern})" if r.either_case else r.pattern) for r in rules}
    asked = {k: q for k, q in queries.items() if q is not ANY}
    rows = docs.drop(spans)
    own = "_" * max(map(len, rows.columns))
    body, doc, kinds = F.coalesce(F.col(text), F.lit("")), f"{own}doc", f"{own}kinds"
    keyed = rows.withColumn(doc, _key(key, text))
    none = F.array().cast("array<string>")
    if asked:
        postings = stored(index(docs, sorted(set().union(*map(trigrams, asked.values()))), key, text), "trigrams")
        found = stored(candidates(postings, asked), "secret-candidates")
        keep = keeper(found, "doc")
        # Only rows that the table of candidates may hold are joined with it.
        near = keep(keyed, F.col(doc)).join(found.select(F.col("doc").alias(doc), F.col("kinds").alias(kinds)), doc, "left")
        far = keep(keyed, F.col(doc), False).withColumn(kinds, none)
        keyed = near.select(*rows.columns, F.coalesce(kinds, none).alias(kinds)).unionByName(far.select(*rows.columns, kinds))
    else:
        keyed = keyed.withColumn(kinds, none)
    empty = F.array().cast("array<struct<start:int,place:int,end:int>>")
    each = []
    for i, r in enumerate(rules):
        # A cheap test first: most texts have no match, and need no span.
        has = F.array_contains(kinds, r.kind) & body.rlike(r.java) if r.kind in asked else body.rlike(r.java)
        each.append(F.when(has, _spans(body, r, i)).otherwise(empty))
    named = F.array(*[F.lit(r.kind) for r in rules])
    shaped = F.transform(F.array_sort(F.concat(*each)), lambda s: F.struct(F.get(named, s["place"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return keyed.withColumn(spans, shaped).select(*rows.columns, spans)
