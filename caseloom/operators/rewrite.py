"""Rule-based rewriting over tables of formulas, templates and scripts."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.strings import occurrences, safe_identifier
from caseloom.operators.events import ordered_text
from caseloom.operators.ordered import with_position
from caseloom.session import broadcast_if_small, materialize

# Rules that travel together as one array; more are applied block after block.
RULE_BLOCK = 10_000
# Leading characters that lead from a formula to the names it may contain.
PREFIX_CHARS = 6
# Formulas of one task that looks for names: a small file of short formulas is much work.
FORMULA_ROWS = 100_000


def replace_all(c: Column | str, rules: Mapping[str, str]) -> Column:
    """Literal replacements applied one after the other in one expression."""
    text = F.col(c) if isinstance(c, str) else c
    for old, new in rules.items():
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def replace_by_table(df: DataFrame, columns: Sequence[str], rules: DataFrame) -> DataFrame:
    """The same with an ordered rule table ``(rank, old, new)``, in blocks of consecutive ranks."""

    def fold(c: str) -> Column:
        return F.aggregate("__rules", F.col(c), lambda s, r: F.replace(s, r["old"], r["new"]))

    placed = with_position(rules.select("rank", "old", "new"), ["rank", "old", "new"], "__pos")
    for low in range(0, placed.count(), RULE_BLOCK):
        block = placed.where((F.col("__pos") >= low) & (F.col("__pos") < low + RULE_BLOCK))
        ordered = block.agg(F.sort_array(F.collect_list(F.struct("rank", "old", "new")))).scalar()
        df = df.withColumn("__rules", ordered).withColumns({c: fold(c) for c in columns}).drop("__rules")
    return df


def replacement_counts(df: DataFrame, columns: Sequence[str], rules: Mapping[str, str]) -> DataFrame:
    """Replacements made per column and rule, each rule counted on the text the earlier rules left."""
    measures, names = [], []
    for c in columns:
        text = F.col(c)
        for old, new in rules.items():
            names.append((c, old))
            measures.append(F.coalesce(F.sum(occurrences(text, old)), F.lit(0)).alias(f"m{len(measures)}"))
            text = F.replace(text, F.lit(old), F.lit(new))
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(old).alias("old"), F.col(f"m{i}").alias("replacements"))
        for i, (c, old) in enumerate(names)
    ]
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def template_variables(c: Column | str, names: Sequence[str] | None = None) -> Column:
    """``<%= name %>`` in its four spacings to ``${name}``, for the given names or for any name."""
    text = F.col(c) if isinstance(c, str) else c
    name = r"\w+" if names is None else "|".join(re.escape(n) for n in sorted(names, key=len, reverse=True))
    return F.regexp_replace(text, rf"<%= ?({name}) ?%>", r"\$\{$1\}")


def rename_references(formulas: DataFrame, names: DataFrame, key: str, template: str, name: str) -> DataFrame:
    """Rewrite names inside formula templates to safe identifiers.

    From left to right the longest name at each place of the original text is replaced; what a replacement puts in is not
    looked at again. Names are found by equality: their first characters tell which lengths to try at a place of a
    formula, so a start that many names share leads to their lengths, not to the names. Formula keys must be unique.
    Starts and names that can be broadcast are: a few of them stand in most formulas, and each would be one task's.
    """
    rules = names.select(F.col(name).alias("old"), safe_identifier(name).alias("new")).where("old <> new and old <> ''").distinct()
    rules = materialize(rules.withColumn("size", F.length("old")), "names")
    starts = rules.groupBy(F.substring("old", 1, PREFIX_CHARS).alias("start")).agg(F.collect_set("size").alias("sizes"))
    longest = F.coalesce(rules.agg(F.max("size")).scalar(), F.lit(0))
    tasks = max(formulas.sparkSession.sparkContext.defaultParallelism, -(-formulas.count() // FORMULA_ROWS))
    formulas = formulas.select(key, template)
    if formulas.rdd.getNumPartitions() < tasks:
        formulas = formulas.repartition(tasks, key)
    text = F.col(template)
    places = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    # Only the part of the text that a name could fill travels.
    rests = F.array_distinct(F.transform(places, lambda i: F.substr(text, i, F.col("__longest"))))
    pieces = formulas.withColumn("__longest", longest).select(key, F.explode(rests).alias("__rest"))
    lengths = F.sequence(F.lit(1), F.lit(PREFIX_CHARS))
    begun = pieces.select(key, "__rest", F.explode(F.array_distinct(F.transform(lengths, lambda n: F.substr("__rest", F.lit(1), n)))).alias("start"))
    tried = begun.join(broadcast_if_small(starts), "start").select(key, F.explode(F.transform("sizes", lambda n: F.substr("__rest", F.lit(1), n))).alias("old")).distinct()
    found = tried.join(broadcast_if_small(rules), "old").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct((-F.col("size")).alias("order"), "old", "new"))).alias("__rules"))
    quoted = F.transform("__rules", lambda r: F.concat(F.lit(r"\Q"), F.replace(r["old"], F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
    pattern = F.array_join(quoted, "|")
    new = F.map_from_entries(F.transform("__rules", lambda r: F.struct(r["old"], r["new"])))
    matches, between = F.regexp_extract_all(text, pattern, F.lit(0)), F.split(text, pattern, F.lit(-1))
    joined = F.zip_with(between, matches, lambda piece, match: F.concat(piece, F.coalesce(F.element_at(new, match), F.lit(""))))
    rewritten = F.when(F.col("__rules").isNotNull(), F.array_join(joined, "")).otherwise(text)
    return formulas.join(found, key, "left").select(key, rewritten.alias(template))


def parameter_ids(df: DataFrame, keys: Sequence[str], parameters: str) -> DataFrame:
    """One row per array element with ids ``p1..pn`` and default 0."""
    return df.select(*keys, F.posexplode(parameters).alias("__i", "display_name")).select(
        *keys, F.concat(F.lit("p"), (F.col("__i") + 1).cast("string")).alias("id"), "display_name", F.lit(0).alias("default_value")
    )


def script_lines(df: DataFrame, key: str, text: str) -> DataFrame:
    """One row per line: ``(key, line_no, line)``."""
    return df.select(key, F.posexplode(F.split(text, "\n")).alias("__i", "line")).select(
        key, (F.col("__i") + 1).alias("line_no"), "line"
    )


def rewrite_lines(lines: DataFrame, rules: Sequence[tuple[str, str]], tag: str = " # CHANGED", line: str = "line") -> DataFrame:
    """Regex rules folded over each line in one pass; changed lines are flagged and tagged."""
    text = F.col(line)
    for pattern, replacement in rules:
        text = F.regexp_replace(text, pattern, replacement)
    out = lines.withColumn("rewritten", text).withColumn("changed", ~F.col("rewritten").eqNullSafe(F.col(line)))
    return out.withColumn("rewritten", F.when(F.col("changed"), F.concat("rewritten", F.lit(tag))).otherwise(F.col("rewritten")))


def aliases(scripts: DataFrame, key: str, text: str, call: str) -> DataFrame:
    """Names that a script binds to a call (``x = call``), per script."""
    pattern = rf"(\S*)\s?=\s?{re.escape(call)}"
    found = F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(pattern), F.lit(1))))
    return scripts.select(key, found.alias("alias"))


def rewrite_with_alias(
    lines: DataFrame, known: DataFrame, key: str, member: str, for_alias: str, otherwise: str, line: str = "line"
) -> DataFrame:
    """Rewrite ``receiver`` + ``member`` by whether the receiver is an alias bound in the same script.

    ``member`` is the pattern after the receiver; in the replacements ``$1`` is the receiver and ``$2`` the first
    group of ``member``. The aliases of a script are one small set taken from its text.
    """
    sets = known.groupBy(key).agg(F.collect_set("alias").alias("__aliases"))
    joined = lines.join(broadcast_if_small(materialize(sets, "aliases")), key, "left")
    quoted = F.transform("__aliases", lambda a: F.concat(F.lit(r"\Q"), a, F.lit(r"\E")))
    either = F.coalesce(F.array_join(quoted, "|"), F.lit(r"[^\s\S]"))
    bound = F.concat(F.lit(r"(?<!\S)("), either, F.lit(")"), F.lit(member))
    unbound = F.concat(F.lit(r"(?<!\S)(?!(?:"), either, F.lit(")"), F.lit(_uncaptured(member)), F.lit(r")(\S*)"), F.lit(member))
    once = joined.withColumn("__once", F.regexp_replace(line, unbound, F.lit(otherwise)))
    return once.withColumn("rewritten", F.regexp_replace("__once", bound, F.lit(for_alias))).drop("__aliases", "__once")


def _uncaptured(pattern: str) -> str:
    """The pattern with its capturing groups made non-capturing."""
    return re.sub(r"(?<!\\)\((?!\?)", "(?:", pattern)


def script_bundle(
    df: DataFrame, keys: Sequence[str], position: str, name: Column, statement: str, part_rows: int = 1_000
) -> DataFrame:
    """Statements of a job under ``--###name###--`` headings in order, nulls left out, as parts of bounded size."""
    blank = F.lit(" \t\n\r\x0b\x0c")
    block = F.concat(F.lit("--###"), name, F.lit("###--\n\n"), F.btrim(F.col(statement), blank), F.lit("\n\n"))
    return ordered_text(df.where(F.col(statement).isNotNull()), keys, position, block, "", part_rows, "bundle")
