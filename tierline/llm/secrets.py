"""Secret scans with a trigram inverted index.

Every rule's pattern is turned into a Boolean query over trigrams that any match must contain. Postings of
those trigrams are intersected and united by the query, and only the texts that remain are verified with
the pattern. A rule whose pattern has no mandatory trigram is matched against all texts in the pass that
builds the index. The index holds lower-case trigrams, so a query never misses a match.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tierline.llm.common import staged, table

# Strings that a part of a pattern may stand for before it counts as open.
MOST_STRINGS = 64
MOST_CHARACTERS = 8
BROADCAST_ROWS = 200_000


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` (a text that Java and Python read alike) whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Fixed values of the contract. The lengths of access keys and hex strings stand in the patterns: a match
# of the open pattern takes a maximal run, so the two forms find the same spans.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "[0-9a-f]{32,}"),
)

# A query: every clause must hold; a clause holds if one of its sets of trigrams is contained.
Clause = frozenset[frozenset[str]]


def _strings(item: tuple) -> set[str] | None:
    """All strings that a parsed part can match, in lower case; None if there are too many."""
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {chr(arg).lower()}
    if op == "IN":
        chars: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < MOST_CHARACTERS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= MOST_CHARACTERS else None
    if op == "SUBPATTERN":
        return _joined(list(arg[3]))
    if op == "BRANCH":
        parts = [_joined(list(b)) for b in arg[1]]
        return None if None in parts else _few(set().union(*parts))
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] <= 3:
        part = _joined(list(arg[2]))
        if part is None:
            return None
        return _few({"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(sorted(part), repeat=n)})
    return {""} if op == "AT" else None


def _few(strings: set[str]) -> set[str] | None:
    return strings if len(strings) <= MOST_STRINGS else None


def _joined(items: list) -> set[str] | None:
    done: set[str] | None = {""}
    for item in items:
        part = _strings(item)
        done = None if part is None else _few({a + b for a in done for b in part})
        if done is None:
            return None
    return done


def _clause(strings: set[str]) -> Clause | None:
    """Of the strings one must occur; None if one of them has no trigram."""
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(s for s in sets if not any(t < s for t in sets))


def _clauses(items: list) -> set[Clause]:
    found: set[Clause] = set()
    run: set[str] = {""}
    for item in items:
        part = _strings(item)
        longer = None if part is None else _few({a + b for a in run for b in part})
        if longer is not None:
            run = longer
            continue
        found.add(_clause(run))
        run = part or {""}
        op, arg = str(item[0]), item[1]
        if op == "SUBPATTERN":
            found |= _clauses(list(arg[3]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
            found |= _clauses(list(arg[2]))
        elif op == "BRANCH" and part is None:
            # One branch must match: any clause of each branch, united, must hold.
            sides = [sorted(_clauses(list(b)), key=sorted) for b in arg[1]]
            if all(sides):
                found.add(frozenset().union(*(side[0] for side in sides)))
    found.add(_clause(run))
    return found - {None}


def trigram_query(pattern: str) -> set[Clause]:
    """The clauses that hold for every text with a match; none if the pattern has no mandatory trigram."""
    # The standard library's parser of patterns; its tree is only read.
    return _clauses(list(re._parser.parse(pattern)))


def _postings(docs: DataFrame, grams: list[str]) -> Column:
    if not grams:
        return F.array().cast("array<string>")
    # The lower-case text is made once and bound to a variable.
    wanted = F.array(*[F.lit(g) for g in grams])
    return F.transform(
        F.array(F.lower("text")), lambda low: F.filter(wanted, lambda g: F.contains(low, g))
    )[0]


def _pieces(rule: Rule) -> Column:
    """Lengths of gap, match and group, by match: text between matches is what a split leaves."""
    lengths = lambda a: F.transform(a, lambda s: F.length(s))
    hits = lambda g: F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(g))
    zipped = F.arrays_zip(
        lengths(F.split("text", rule.pattern, -1)).alias("gap"),
        lengths(hits(0)).alias("hit"),
        lengths(hits(rule.group)).alias("size"),
    )
    return F.filter(zipped, lambda p: p["hit"].isNotNull())


def _spans(pieces: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """id1, id2, kind (place of the rule), start, end of the matches that are long enough.

    ``pieces``: id1, id2, kind, pieces. A window holds the matches of one text.
    """
    least = reduce(lambda c, r: F.when(F.col("kind") == r[0], r[1].least).otherwise(c), enumerate(rules), F.lit(1))
    flat = pieces.select("id1", "id2", "kind", F.posexplode("pieces").alias("i", "p"))
    so_far = Window.partitionBy("id1", "id2", "kind").orderBy("i")
    end = F.sum(F.col("p.gap") + F.col("p.hit")).over(so_far)
    return (
        flat.withColumn("end", end)
        .where(F.col("p.size") >= least)
        .select("id1", "id2", "kind", (F.col("end") - F.col("p.hit")).alias("start"), "end")
    )


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and ``spans``, sorted by start and rule.

    A span is (start, kind, end) in code points, end exclusive, kind being the rule's place. Matches are
    leftmost and do not overlap within a rule; those whose group is too short are dropped. Null texts
    count as empty and have no spans; rows with equal id and text get equal spans.
    """
    text = F.coalesce("text", F.lit(""))
    # Rows are known by id and text; a null id differs from all others by the second key.
    keyed = docs.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(0)).alias("id1"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("id2"),
        text.alias("text"),
    )
    queries = {k: trigram_query(r.pattern) for k, r in enumerate(rules)}
    grams = sorted({g for q in queries.values() for c in q for a in c for g in a})
    scanned = [k for k, q in queries.items() if not q]
    index = staged(
        keyed.select(
            "doc_id", "id1", "id2", _postings(keyed, grams).alias("grams"),
            F.array(
                *[F.struct(F.lit(k).alias("kind"), _pieces(rules[k]).alias("pieces")) for k in scanned]
            ).alias("scanned"),
        ),
        "trigrams",
    )
    found = []
    if scanned:
        found.append(index.select("id1", "id2", F.explode("scanned").alias("s")))
    if grams:
        candidates = staged(_candidates(index, queries), "candidates")
        if candidates.count() <= BROADCAST_ROWS:
            candidates = F.broadcast(candidates)
        tried = [
            F.struct(F.lit(k).alias("kind"), F.when(F.array_contains("kinds", k), _pieces(rules[k])).alias("pieces"))
            for k, q in queries.items()
            if q
        ]
        chosen = keyed.join(candidates, ["id1", "id2"])
        found.append(chosen.select("id1", "id2", F.explode(F.array(*tried)).alias("s")))
    pieces = reduce(DataFrame.union, found).select("id1", "id2", "s.kind", "s.pieces")
    pieces = pieces.where(F.size("pieces") > 0).dropDuplicates(["id1", "id2", "kind"])
    found = staged(pieces, "pieces")
    spans = (
        _spans(found, rules)
        .groupBy("id1", "id2")
        .agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    )
    return index.select("doc_id", "id1", "id2").join(spans, ["id1", "id2"], "left").select(
        "doc_id", F.coalesce("spans", F.array().cast(spans.schema["spans"].dataType)).alias("spans")
    )


def _candidates(index: DataFrame, queries: dict[int, set[Clause]]) -> DataFrame:
    """id1, id2 and the rules (``kinds``) whose queries hold, by intersecting postings."""
    spark = index.sparkSession
    # One row per trigram of each alternative; there are as many as the rules have, whatever the input.
    rows = [
        (k, c, a, len(grams), len(queries[k]), gram)
        for k in queries
        for c, clause in enumerate(sorted(queries[k], key=str))
        for a, grams in enumerate(sorted(clause, key=sorted))
        for gram in sorted(grams)
    ]
    terms = spark.createDataFrame(rows, "kind int, clause int, alt int, grams int, clauses int, gram string")
    postings = index.select("id1", "id2", F.explode("grams").alias("gram")).distinct()
    met = (
        postings.join(F.broadcast(terms), "gram")
        .groupBy("id1", "id2", "kind", "clause", "alt", "grams", "clauses")
        .agg(F.count("*").alias("n"))
        .where("n = grams")
        .select("id1", "id2", "kind", "clause", "clauses")
        .distinct()
    )
    hold = met.groupBy("id1", "id2", "kind", "clauses").agg(F.count("*").alias("n")).where("n = clauses")
    return hold.groupBy("id1", "id2").agg(F.collect_list("kind").alias("kinds"))


def op8_secret_trigrams(spark, sf_dir: str) -> DataFrame:
    """Counts and digest of the secrets in every document."""
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    name = F.array(*[F.lit(r.kind) for r in RULES])
    text = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    joined = F.array_join(F.transform("spans", text), ",")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{r.kind}") for k, r in enumerate(RULES)],
        F.sha2(joined, 256).alias("base_sha256"),
        joined.alias("spans"),
    )
