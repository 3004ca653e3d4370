"""Secret scanning with a trigram inverted index, in DataFrame expressions.

From every rule's pattern a Boolean query over trigrams is derived: each text the pattern matches contains all
trigrams of at least one clause.  The index lists, for every trigram some query asks for, the documents that
contain it; the postings of a clause are intersected, and only the documents left are searched with the rule's
pattern.  A rule whose pattern has no mandatory trigram is searched in all documents.

Postings carry a digest of id and text, so repeated rows share their postings, and two documents with one digest
would only both be searched.  Intersection is a bit mask per clause and document, combined before the shuffle.
The candidates are written, and their size decides whether they are broadcast.

Null and empty texts have no finds.  Repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import product
from re import _parser as regex_parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerbench.session import stored


class Rule(NamedTuple):
    """A kind of secret; ``group`` of a match must have ``least`` characters, else the match is dropped."""

    kind: str
    pattern: str
    group: int
    least: int
    any_case: bool = False


# Fixed formats.  The first three are the base rules, in the order of ties.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]+", 0, 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 20),
)
BASE = 3
# Finds placed together.
FINDS = 256
# A set of characters up to this size is spelled out in a query; a larger one ends the stretch.
SPELLED = 6


def _choices(item) -> list[str] | None:
    """All texts that an element of a parsed pattern can match, None if they are too many."""
    kind, value = str(item[0]), item[1]
    if kind == "LITERAL":
        return [chr(value)]
    if kind == "IN":
        if all(str(k) == "LITERAL" for k, _ in value) and len(value) <= SPELLED:
            return [chr(v) for _, v in value]
        return None
    if kind == "SUBPATTERN":
        return _exact(value[-1])
    if kind == "BRANCH":
        found = [_exact(branch) for branch in value[1]]
        return None if None in found else [text for texts in found for text in texts]
    if kind == "MAX_REPEAT" and value[:2] == (0, 1):
        inner = _exact(value[2])
        return None if inner is None or len(inner) > 1 else ["", *inner]
    return None


def _exact(sequence) -> list[str] | None:
    parts = [_choices(item) for item in sequence]
    return None if None in parts else ["".join(x) for x in product(*parts)]


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """Clauses of small-letter trigrams, one of which every match contains; empty if there is none to ask for.

    Every stretch of the pattern that can be spelled out gives a query: one clause for each spelling.  The
    query whose smallest clause is largest is used; leaving out the others keeps it necessary.
    """
    queries, stretch = [], [""]
    for item in [*regex_parser.parse(pattern), None]:
        choices = _choices(item) if item else None
        if choices is not None and len(stretch) * len(choices) <= 64:
            stretch = [a + b for a, b in product(stretch, choices)]
            continue
        lowered = {text.lower() for text in stretch}
        queries.append([frozenset(t[i : i + 3] for i in range(len(t) - 2)) for t in sorted(lowered)])
        stretch = choices or [""]
    best = max(queries, key=lambda clauses: min(map(len, clauses)))
    return best if min(map(len, best)) else []


def java_pattern(rule: Rule) -> str:
    return ("(?i)" if rule.any_case else "") + rule.pattern


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """Array of (start, place, kind, end) of the rule's matches, leftmost and without overlap."""
    pattern = java_pattern(rule)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group))
    kind = "struct<start:int,place:int,kind:string,end:int>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.length(x["match"])
        span = F.struct(start.alias("start"), F.lit(place).alias("place"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        spans = F.when(F.length(x["tested"]) >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def in_chunk(chunk: Column, start: Column) -> Column:
        state = F.struct(start.alias("at"), F.array().cast(f"array<{kind}>").alias("spans"))
        return F.aggregate(chunk, state, step, lambda acc: acc["spans"])

    def width(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0), lambda acc, x: acc + F.length(x["piece"]) + F.length(x["match"]))

    def starts(chunks: Column) -> Column:
        state = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out"))

        def add(acc: Column, chunk: Column) -> Column:
            return F.struct((acc["at"] + width(chunk)).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out"))

        return F.aggregate(chunks, state, add, lambda acc: acc["out"])

    def chunked(found: Column) -> Column:
        last = F.call_function("div", F.greatest(F.size(found) - 1, F.lit(0)), F.lit(FINDS)).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(found, i * FINDS + 1, F.lit(FINDS)))

    # What lies between the matches, one more than there are matches.
    pieces = F.split(text, pattern, -1)
    zipped = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), tested.alias("tested"))
    found = F.filter(zipped, lambda x: x["match"].isNotNull())
    # An array grows by copying, so finds are placed in chunks: time grows with their number, not with its square.
    chunks = _with(found, chunked)
    return _with(chunks, lambda cut: F.flatten(F.zip_with(cut, starts(cut), in_chunk)))


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` mentions it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def postings(docs: DataFrame, key: Column, text: Column, trigrams: list[str]) -> DataFrame:
    """The inverted index: ``trigram`` (its number) and ``key`` of the documents that contain it."""
    read = docs.select(key.alias("key"), F.lower(text).alias("text"))
    present = [F.when(F.contains("text", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams)]
    return read.select("key", F.explode(F.array_compact(F.array(*present))).alias("trigram"))


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]], trigrams: list[str]) -> DataFrame:
    """``key`` and ``rules``, a bit for every rule that has a clause whose trigrams are all in the document."""
    number = {t: i for i, t in enumerate(trigrams)}
    rows = [
        (number[t], rule, clause, 1 << bit, (1 << len(parts)) - 1, 1 << rule)
        for rule, clauses in queries.items()
        for clause, parts in enumerate(clauses)
        for bit, t in enumerate(sorted(parts))
    ]
    # As many rows as the rules have trigrams.
    columns = ("trigram", "rule", "clause", "bit", "full", "flag")
    row = F.explode(F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(columns, r)]) for r in rows]))
    wanted = index.sparkSession.range(1).select(row.alias("w")).select("w.*")
    met = (
        index.join(F.broadcast(wanted), "trigram")
        .groupBy("key", "rule", "clause", "full", "flag")
        .agg(F.bit_or("bit").alias("met"))
    )
    return met.where("met = full").groupBy("key").agg(F.bit_or("flag").alias("rules"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, base: int = BASE
) -> DataFrame:
    """``_id`` and ``_spans``, array of (start, place, kind, end) by start and place, for every row."""
    queries = {i: clauses for i, rule in enumerate(rules) if (clauses := trigram_query(rule.pattern))}
    trigrams = sorted({t for clauses in queries.values() for clause in clauses for t in clause})
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), key.alias("_key"))
    joined = rows
    if queries:
        index = stored(postings(docs, key, text, trigrams), "secret-index")
        found = stored(
            candidates(index, queries, trigrams).select(F.col("key").alias("_candidate"), "rules"), "secret-candidates"
        )
        joined = rows.join(found, F.col("_key") == F.col("_candidate"), "left")
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    spans = []
    for place, rule in enumerate(rules):
        if place in queries:
            due = F.col("rules").bitwiseAND(F.lit(1 << place)) != 0
        elif rule.group == 0 and not rule.any_case and re.fullmatch(r"\[[^\]\[\\]+\]\+", rule.pattern):
            # One class, repeated: whether there is any long enough match is seen much faster than where.
            due = F.col("_text").rlike(rule.pattern.removesuffix("+") + "{%d,}" % rule.least)
        else:
            due = F.lit(True)
        spans.append(F.when(due, spans_of(F.col("_text"), rule, place)).otherwise(none))
    return joined.select("_id", F.array_sort(F.concat(*spans)).alias("_spans"))


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_assign, n_access, n_hex, base_sha256 and spans of every row."""
    found = scan(docs, id_col, text_col)

    def count(place: int) -> Column:
        own = F.filter("_spans", lambda s: s["place"] == place)
        return F.size(own).cast("bigint").alias(f"n_{RULES[place].kind}")

    counts = [count(place) for place in range(BASE)]
    basic = F.filter("_spans", lambda s: s["place"] < BASE)
    return found.select(
        F.col("_id").alias(id_col),
        *counts,
        F.sha2(joined_spans(basic).cast("binary"), 256).alias("base_sha256"),
        joined_spans(F.col("_spans")).alias("spans"),
    )


def oracle() -> str:
    """The same finds by searching every text with every pattern."""

    def one(place: int, rule: Rule) -> str:
        pattern = java_pattern(rule).replace("'", "''")
        return f"""
    SELECT doc_id, t, {place} AS place, '{rule.kind}' AS kind, {rule.least} AS least,
        regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {rule.group}) AS g,
        string_split_regex(t, '{pattern}') AS p
    FROM texts"""

    union = "\n    UNION ALL".join(one(i, rule) for i, rule in enumerate(RULES))
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
searched AS ({union}
), placed AS (
    SELECT doc_id, place, kind, least, g, [length(x) for x in m] AS ml, [length(x) for x in p] AS pl
    FROM searched WHERE len(m) > 0
), numbered AS (
    SELECT *, unnest(range(1, len(ml) + 1)) AS i FROM placed
), spans AS (
    SELECT doc_id, place, kind,
        (list_sum(pl[1:i]) + coalesce(list_sum(ml[1:i - 1]), 0))::BIGINT AS s,
        (list_sum(pl[1:i]) + list_sum(ml[1:i]))::BIGINT AS e
    FROM numbered WHERE length(g[i]) >= least
), grouped AS (
    SELECT doc_id, count(*) FILTER (place = 0) AS n_assign, count(*) FILTER (place = 1) AS n_access,
        count(*) FILTER (place = 2) AS n_hex,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (place < {BASE}) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
    FROM spans GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN grouped USING (doc_id)
"""
