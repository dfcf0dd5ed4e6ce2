"""Secret scan with a trigram inverted index, in DataFrame functions only.

From every rule's regular expression a Boolean query over trigrams is derived: a text that
matches must satisfy it.  An index lists, for each trigram that some rule asks for, the
documents that hold it (lower-cased).  The postings are intersected per rule, and only the
documents that satisfy a rule's query are verified with its expression.  A rule without
mandatory trigrams (``hex``) scans every text.

The index is keyed by document id, written to the shared folder, and holds no text.  The
candidates are broadcast while their counted rows are few; beyond that they are joined by
a shuffle, which AQE splits if one id is frequent.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from functools import reduce
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstream.llm.common import Written, set_aside, small_or_shuffled


@dataclass(frozen=True)
class Rule:
    """``group`` must have ``least`` characters, else the match is dropped.

    ``search`` finds the same matches in time linear in the text, where ``pattern`` itself
    would not; its first group then stands before the match and is no part of it.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    search: str | None = None


# The three base kinds.  ``[0-9a-f]+`` of 16 and more is ``[0-9a-f]{16,}``,
# because a run of these characters is always matched whole.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?"
         r"([A-Za-z0-9+/_.=-]+)", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    Rule("hex", r"[0-9a-f]{16,}"),
)
# Published forms of further credentials.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # A run of these characters is entered at its beginning only, and its first ``eyJ`` decides:
    # if that one finds no dots and runs after it, no later one does.
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}",
         search=r"(?<![A-Za-z0-9_-])((?>[A-Za-z0-9_-]*?(?=eyJ)))eyJ[A-Za-z0-9_-]{10,}+"
                r"\.[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    # Up to the END line in any layout, also with escaped line ends; without it, up to the end
    # of the base-64 lines.  One character class, since Java recurses on repeated groups.
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[\x5Crn\x20\t\r\n]*Proc-Type:\x20*[0-9A-Z,]+)?"
         r"(?:[\x5Crn\x20\t\r\n]*DEK-Info:\x20*[0-9A-Z-]+,[0-9A-Fa-f]+)?"
         r"(?:[A-Za-z0-9+/=\x5C\x20\t\r\n]*-----END [A-Z ]*PRIVATE KEY-----|[\x20\t]*[A-Za-z0-9+/=\x5C\r\n]*)"),
    Rule("url_login", r"://[^\x00-\x20/:@]+:[^\x00-\x20/:@]{4,}@"),
)
RULES = BASE + MORE

# Most strings that an exactly known part of an expression may stand for.
MAX_STRINGS = 16
BITS = 62
# Matches of a text that are put in place at a time.
PART = 512

# A query is True (no condition), a trigram, or ("and" | "or", parts).


def _joined(kind: str, parts: list):
    """``and`` drops True; ``or`` with True is True."""
    if kind == "or" and True in parts:
        return True
    parts = list(dict.fromkeys(p for p in parts if p is not True))
    if len(parts) < 2:
        return parts[0] if parts else True
    return (kind, tuple(parts))


def _of_strings(strings: set[str]):
    """The text contains one of these strings."""
    return _joined("or", [
        _joined("and", [s[i:i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _exact(op, arg) -> set[str] | None:
    """The lower-cased strings a part can stand for, if they are few."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        out: set[str] = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                out.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < MAX_STRINGS:
                out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return out if len(out) <= MAX_STRINGS else None
    return None


def _walk(items) -> tuple[set[str] | None, object]:
    """(exact strings or None, query) of a sequence of parsed parts."""
    run, conditions, whole = {""}, [], True
    for op, arg in items:
        name, strings, query = str(op), None, True
        if name in ("LITERAL", "IN"):
            strings = _exact(op, arg)
        elif name == "SUBPATTERN":
            strings, query = _walk(arg[3])
        elif name == "BRANCH":
            found = [_walk(x) for x in arg[1]]
            query = _joined("or", [q for _, q in found])
            if all(s is not None for s, _ in found):
                strings = set().union(*(s for s, _ in found))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            low, high, part = arg
            inner, inner_query = _walk(part)
            query = inner_query if low else True
            if inner is not None and (low, high) == (0, 1):
                strings = inner | {""}
            elif inner is not None and low == high and len(inner) ** low <= MAX_STRINGS:
                strings = {"".join(x) for x in itertools.product(inner, repeat=low)}
        if strings is not None and len(strings) * len(run) <= MAX_STRINGS:
            run = {a + b for a in run for b in strings}
        else:
            whole = False
            conditions += [_of_strings(run), query if strings is None else _of_strings(strings)]
            run = strings if strings is not None and len(strings) <= MAX_STRINGS else {""}
    return (run, _of_strings(run)) if whole else (None, _joined("and", [*conditions, _of_strings(run)]))


def trigram_query(pattern: str):
    """Boolean trigram query that every text with a match satisfies."""
    return _walk(parser.parse(pattern))[1]


def grams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(grams_of, query[1]))


def holds(query, has) -> Column:
    """The query as a column; ``has(gram)`` tells whether the document is in its posting."""
    if query is True:
        return F.lit(True)
    if isinstance(query, str):
        return has(query)
    parts = [holds(q, has) for q in query[1]]
    return reduce(lambda a, b: a & b if query[0] == "and" else a | b, parts)


def trigram_index(docs: DataFrame, grams: list[str]) -> DataFrame:
    """Postings (gram, doc_id) of the given trigrams; ``gram`` is the place in ``grams``."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    present = F.array_compact(F.array(*[
        F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]))
    return low.select(F.explode(present).alias("gram"), "doc_id")


def candidates(postings: DataFrame, grams: list[str], queries: list) -> DataFrame:
    """(doc_id, rules): the rules, as bits, whose query the document's postings satisfy."""
    words = range(-(-len(grams) // BITS))
    own_word = (F.col("gram") / BITS).cast("int")
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("gram") % BITS)
    bits = [F.bit_or(F.when(own_word == w, one)).alias(f"w{w}") for w in words]
    place = {g: i for i, g in enumerate(grams)}

    def has(gram):
        i = place[gram]
        return F.coalesce(F.col(f"w{i // BITS}").bitwiseAND(F.lit(1 << (i % BITS))) != 0, F.lit(False))

    met = [F.when(holds(q, has), F.lit(1 << k)).otherwise(F.lit(0)) for k, q in enumerate(queries)]
    rules = reduce(lambda a, b: a.bitwiseOR(b), met).cast("bigint")
    return postings.groupBy("doc_id").agg(*bits).select("doc_id", rules.alias("rules")).filter("rules <> 0")


def _spans(rule: Rule, place: int) -> Column:
    """Matches of one rule as (start, place, end), in code points, end exclusive.

    The text between the matches and the matches themselves alternate, so their lengths
    add up to the positions.
    """
    pattern = rule.search or rule.pattern

    def lengths(group: int) -> Column:
        return F.transform(F.regexp_extract_all(F.col("text"), F.lit(pattern), F.lit(group)), F.length)

    found = lengths(0)
    gaps = F.transform(F.split(F.col("text"), pattern, -1), F.length)
    parts = F.arrays_zip(gaps.alias("gap"), found.alias("length"), lengths(rule.group).alias("size"),
                         (lengths(1) if rule.search else F.transform(found, lambda x: F.lit(0))).alias("lead"))
    kind = "array<struct<start:int,place:int,end:int,size:int>>"

    def step(acc, x):
        before = acc["at"] + x["gap"]
        start, end = before + x["lead"], before + x["length"]
        new = F.struct(start.alias("start"), F.lit(place).alias("place"), end.alias("end"), x["size"].alias("size"))
        # The last gap has no match after it.
        return F.struct(F.coalesce(end, before).alias("at"),
                        F.when(end.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], new)).alias("out"))

    def fold(part, at):
        return F.aggregate(part, F.struct(at.alias("at"), F.array().cast(kind).alias("out")), step)

    spans = F.flatten(_fold(parts, fold, kind)["out"])
    return F.transform(F.filter(spans, lambda x: x["size"] >= rule.least),
                       lambda x: F.struct(x["start"], x["place"], x["end"]))


def _bound(value: Column, use) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _fold(items: Column, fold, kind: str) -> Column:
    """Struct (at, out) from folding ``items`` part by part from ``at`` 0 on; ``out`` lists the parts'
    arrays.  Appending copies an array, so one fold over n items would take n * n / 2 steps."""
    def folded(all_items):
        parts = F.transform(F.sequence(F.lit(0), F.greatest(F.size(all_items) - 1, F.lit(0)), F.lit(PART)),
                            lambda i: F.slice(all_items, i + 1, PART))

        def step(acc, part):
            return _bound(fold(part, acc["at"]), lambda done: F.struct(
                done["at"].alias("at"), F.array_append(acc["out"], done["out"]).alias("out")))

        return F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind}>").alias("out")), step)

    return _bound(items, folded)


def _written_out(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["place"]), x["start"].cast("string"), x["end"].cast("string"))))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``found``: array of (start, place, end) over all rules, sorted.

    ``place`` is the rule's number.  Needs ``doc_id`` and ``text``; all other columns are
    kept.  Null texts count as empty and give an empty array.  Rows with a null or
    repeated id are found too: the index only narrows which texts are verified, and equal
    ids share their candidates.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    grams = sorted(set().union(*map(grams_of, queries)))
    indexed = [k for k, q in enumerate(queries) if q is not True]
    postings = Written(trigram_index(docs, grams), "trigrams").df
    chosen = Written(candidates(postings, grams, [queries[k] for k in indexed]), "candidates").df
    chosen = small_or_shuffled(chosen).select(F.col("doc_id").alias("_id"), F.col("rules").alias("_rules"))
    joined = docs.join(chosen, docs["doc_id"].eqNullSafe(F.col("_id")), "left").drop("_id")
    none = F.array().cast("array<struct<start:int,place:int,end:int>>")
    parts = []
    for place, rule in enumerate(rules):
        spans = F.coalesce(_spans(rule, place), none)
        if place in indexed:
            bit = 1 << indexed.index(place)
            spans = F.when(F.col("_rules").bitwiseAND(F.lit(bit)) != 0, spans).otherwise(none)
        else:
            # One search tells that there is nothing to take apart.
            spans = F.when(F.col("text").rlike(rule.search or rule.pattern), spans).otherwise(none)
        parts.append(spans)
    return joined.withColumn("found", F.array_sort(F.concat(*parts))).drop("_rules")


def find_secrets(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, a digest of the base spans, all spans.

    Null texts count as empty: no spans, and the digest of an empty string.
    """
    found = scan(docs.select("doc_id", "text"))
    base = F.filter("found", lambda x: x["place"] < len(BASE))

    def number(place: int) -> Column:
        return F.size(F.filter("found", lambda x: x["place"] == place)).cast("bigint")

    count = [number(k).alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return found.select("doc_id", *count, F.sha2(_written_out(base, RULES), 256).alias("base_sha256"),
                        _written_out(F.col("found"), RULES).alias("spans"))


def redact(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """``docs`` with every secret, or chain of overlapping ones, replaced by ``mark``.

    ``n_chars`` follows the new text.  Rows without secrets are unchanged; columns stay.
    """
    def fold(spans, at):
        """Pieces of the text from ``at`` to the last end in ``spans``; cut from that stretch."""
        def cut(stretch):
            def step(acc, x):
                gap = F.substring(stretch, acc["at"] - at + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
                new = F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.array(gap, F.lit(mark)))).otherwise(acc["out"])
                return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), new.alias("out"))

            return F.aggregate(spans, F.struct(at.alias("at"), F.array().cast("array<string>").alias("out")), step)

        last = F.coalesce(F.array_max(F.transform(spans, lambda x: x["end"])), at)
        return _bound(F.substring(F.col("text"), at + 1, F.greatest(last - at, F.lit(0))), cut)

    rest = lambda done: F.concat(F.array_join(F.flatten(done["out"]), ""), F.substring(F.col("text"), done["at"] + 1, F.length("text")))
    hit = F.size("found") > 0
    apart, back = set_aside(docs, "doc_id", "text", "n_chars")
    replaced = _bound(_fold(F.col("found"), fold, "array<string>"), rest)
    out = scan(apart).withColumn("text", F.when(hit, replaced).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        size = F.when(hit, F.length("text")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", size.cast(docs.schema["n_chars"].dataType))
    return out.select(*back)
