"""Secret scan over a trigram inverted index, in DataFrame functions only.

1. On the driver, each rule's regular expression is parsed and turned into a Boolean
   trigram query: an OR of clauses, each an AND of trigrams that any match must contain
   (lower-cased). A rule from which no mandatory trigram follows scans every text.
2. The index has the postings of the trigrams that some rule asks for: for each block of
   documents and trigram the sorted ids of the documents whose lower-cased text holds it.
   Blocks bound the length of a posting list, however common the trigram.
3. Each rule's query is answered in each block by intersecting and uniting postings.
4. Candidates are verified with the rule's regular expression on the whole text.

Defined cases: null text is empty and gives no spans; a null id isn't indexed and its row
is verified for every rule; rows with the same id share their candidate rules, which only
adds verifications; an empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import bound, materialise, sums_before


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and non-overlapping; then those stay whose
    ``group`` has at least ``min_chars`` characters. ``base`` marks the contract's kinds."""

    kind: str
    regex: str
    group: int = 0
    min_chars: int = 0
    base: bool = False


#: The kinds, in the order that ties of start follow.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, True),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32, True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: Strings kept exact while a query is derived; beyond, what is known so far is used up.
MAX_EXACT = 64
#: Documents in a block of the index, about.
BLOCK_DOCS = 4096
#: Candidate documents up to which their ids are broadcast (16 bytes each); beyond, Spark joins by id.
BROADCAST_CANDIDATES = 500_000

Query = frozenset  # of clauses, each a frozenset of trigrams; a query with an empty clause is always true
TRUE = frozenset([frozenset()])


def _absorbed(clauses) -> frozenset:
    """Without the clauses that imply another one."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _and(a: frozenset, b: frozenset) -> frozenset:
    both = _absorbed({x | y for x in a for y in b})
    return both if len(both) <= MAX_EXACT else min(a - TRUE, b - TRUE, key=len, default=TRUE) or TRUE


def _needs(strings: set[str]) -> frozenset:
    """Query for: the text holds one of the strings."""
    return _absorbed({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _sequence(items) -> tuple[set[str] | None, frozenset]:
    """(all strings that the items match, or None if not a short list; query)."""
    exact, query, current, whole = {""}, TRUE, {""}, True

    def use_up():
        nonlocal query, current, whole
        query, current, whole = _and(query, _needs(current)), {""}, False

    for op, arg in items:
        strings, inner = None, TRUE
        if op is sre.LITERAL:
            strings = {chr(arg).lower()}
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg):
            strings = {chr(a).lower() for _, a in arg}
        elif op is sre.SUBPATTERN:
            strings, inner = _sequence(arg[3])
        elif op is sre.BRANCH:
            parts = [_sequence(x) for x in arg[1]]
            if all(p[0] is not None for p in parts):
                strings = set().union(*[p[0] for p in parts])
            inner = _absorbed(set().union(*[p[1] for p in parts]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, body = arg
            strings, once = _sequence(body)
            if (low, high) == (0, 1) and strings is not None:
                strings = strings | {""}
            elif low == high and strings is not None and len(strings) ** low <= MAX_EXACT:
                strings = reduce(lambda a, _: {x + y for x in a for y in strings}, range(low), {""})
            else:
                strings, inner = None, once if low else TRUE
        elif op is sre.AT:
            continue
        if strings is not None and len(current) * len(strings) <= MAX_EXACT:
            current = {x + y for x in current for y in strings}
            exact = current if whole else exact
        else:
            use_up()
            query = _and(query, inner)
            if strings is not None:
                current = strings
    return (current if whole else None), _and(query, _needs(current))


def trigram_query(regex: str) -> frozenset | None:
    """Clauses of trigrams, or None if no trigram is mandatory."""
    query = _sequence(sre_parser.parse(regex))[1]
    return None if frozenset() in query else query


def _postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The index: __block, __gram (a trigram's place in ``trigrams``), __ids."""
    blocks = max(1, docs.count() // BLOCK_DOCS)
    low = docs.where(F.col("__id").isNotNull()).select("__id", F.lower("__text").alias("__low"))
    # One bit for each trigram, in words of 60 bits: plain arithmetic, which Spark compiles.
    words = [trigrams[i : i + 60] for i in range(0, len(trigrams), 60)]
    bits = [reduce(Column.bitwiseOR, [F.when(F.contains("__low", F.lit(g)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, g in enumerate(w)])
            for w in words]
    masks = low.select("__id", *[b.alias(f"__m{i}") for i, b in enumerate(bits)])
    # The masks' bits are opened by a join-free generator of fixed length and a filter.
    rows = masks.withColumn("__gram", F.explode(F.array(*[F.lit(i) for i in range(len(trigrams))])))
    bit = reduce(lambda rest, i: F.when(F.col("__gram") < 60 * (i + 1), F.col(f"__m{i}")).otherwise(rest), reversed(range(len(words))), F.lit(0).cast("long"))
    held = rows.where(bit.bitwiseAND(F.expr("shiftleft(1L, __gram % 60)")) != 0)
    block = F.pmod(F.xxhash64("__id"), F.lit(blocks)).cast("int").alias("__block")
    return held.select("__id", block, "__gram").groupBy("__block", "__gram").agg(F.sort_array(F.collect_set("__id")).alias("__ids"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """__id and __rules, the bits of the rules to verify. For rules that have a query."""
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.regex)) is not None}
    grams = sorted({g for q in queries.values() for c in q for g in c})
    index = materialise(_postings(docs, grams), "postings")
    block = index.groupBy("__block").agg(*[
        F.coalesce(F.first(F.when(F.col("__gram") == i, F.col("__ids")), ignorenulls=True), F.array().cast(index.schema["__ids"].dataType)).alias(f"g{i}")
        for i, g in enumerate(grams)])
    at = {g: F.col(f"g{i}") for i, g in enumerate(grams)}

    def answer(k: int, query: frozenset) -> Column:
        ids = reduce(F.array_union, [reduce(F.array_intersect, [at[g] for g in sorted(c)]) for c in sorted(query, key=sorted)])
        return F.transform(ids, lambda x: F.struct(x.alias("__id"), F.lit(1 << k).alias("__bit")))

    rows = block.select(F.explode(F.concat(*[answer(k, q) for k, q in queries.items()])).alias("x")).select("x.*")
    return rows.groupBy("__id").agg(F.bit_or("__bit").alias("__rules"))


def _spans(text: Column, rule: Rule, k: int) -> Column:
    """Spans of one rule, from the lengths of the pieces between matches and of the matches."""
    pieces, whole = F.split(text, rule.regex, -1), F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    parts = F.arrays_zip(F.transform(F.slice(pieces, 1, F.size(whole)), F.char_length).alias("gap"),
                         F.transform(whole, F.char_length).alias("run"), F.transform(value, F.char_length).alias("value"))
    def placed(ps: Column) -> Column:
        begun = sums_before(F.transform(ps, lambda p: p["gap"] + p["run"]))
        span = lambda p, at: F.when(p["value"] >= rule.min_chars, F.struct(
            (at + p["gap"]).alias("start"), F.lit(k).alias("order"), (at + p["gap"] + p["run"]).alias("end"), F.lit(rule.kind).alias("kind")))
        return F.filter(F.zip_with(ps, begun, span), lambda s: s.isNotNull())

    return bound(parts, placed)


def _none() -> Column:
    return F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and spans (array of start, order, end, kind; code points, end exclusive; by start, then rule)."""
    source = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    full = sum(1 << k for k, r in enumerate(rules) if trigram_query(r.regex) is None)
    todo = materialise(candidates(source, rules), "candidates")
    todo = F.broadcast(todo) if todo.count() <= BROADCAST_CANDIDATES else todo
    every = (1 << len(rules)) - 1
    mask = F.when(F.col("__id").isNull(), F.lit(every)).otherwise(F.coalesce("__rules", F.lit(0)).bitwiseOR(F.lit(full)))
    rows = source.join(todo, "__id", "left").select("__id", "__text", mask.alias("__mask"))
    text = F.col("__text")
    each = [F.when((F.col("__mask").bitwiseAND(F.lit(1 << k)) != 0) & text.rlike(r.regex), _spans(text, r, k)).otherwise(_none())
            for k, r in enumerate(rules)]
    return rows.select(F.col("__id").alias(id_col), F.sort_array(F.concat(*each)).alias("spans"))
