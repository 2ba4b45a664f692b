"""Rule-based text quality: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked

# White space between words, symbols, and frequent function words of four languages.
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the be to of and that have with is in for "
    "le la les de des du et en que un une "
    "der die das und ist den von zu mit ein eine "
    "el los las y es para con por una al se"
).split()


@dataclass(frozen=True)
class Rule:
    """A text is rejected where ``measure`` is under ``least`` or over ``most``."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def holds(self) -> str:
        bounds = [f"{self.measure} >= {self.least}"] * (self.least is not None)
        bounds += [f"{self.measure} <= {self.most}"] * (self.most is not None)
        return f"({' AND '.join(bounds)})"


#: Measures are SQL over the counts below; ratios are by words or lines.
RULES = (
    Rule("word_length", "word_chars / greatest(n_words, 1)", least=2, most=12),
    Rule("symbols", "n_symbols / greatest(n_words, 1)", most=0.1),
    Rule("shouting", "n_exclamations / greatest(n_words, 1)", most=0.4),
    Rule("stop_words", "n_stop_words / greatest(n_words, 1)", least=0.04),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.5),
)
WINDOW = 8
#: A row number beside the counts. A filter on the verdict cannot move below it, where it would copy all counts.
ROW = "_boxloom_row"
VERDICTS = ["base_failed", "failed_rules", "kept"]
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words", "n_exclamations"]


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def _measured(docs: DataFrame, text: str) -> tuple[list[str], DataFrame]:
    """The names of the passed columns, and rows of these packed in ``_in``, the counts and ``ROW``.

    ``n_repeat_words`` counts words in windows of eight that occur twice or more in the text; windows are
    compared by 64-bit hashes, and only texts where two agree are looked at further.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    passed, row = packed(docs, COUNTS + VERDICTS)
    rows = docs.select(row.alias("_in"), body.alias("_t"), _words(body).alias("_ws"))
    lines = F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_ls", lines).withColumn(
        "_hs",
        F.expr(
            f"if(size(_ws) < {WINDOW}, array(), transform(sequence(1, size(_ws) - {WINDOW - 1}), i -> xxhash64(slice(_ws, i, {WINDOW}))))"
        ).cast("array<bigint>"),
    )
    # (hash, place) in order, of texts with a repeated window only
    rows = rows.withColumn(
        "_sorted",
        F.expr(
            "if(size(array_distinct(_hs)) = size(_hs), array(), "
            "array_sort(transform(_hs, (h, i) -> named_struct('h', h, 'i', i))))"
        ).cast("array<struct<h:bigint,i:int>>"),
    )
    rows = rows.withColumn(
        "_at",
        F.expr(
            "array_sort(transform(filter(_sorted, (x, k) -> "
            "(k > 0 AND _sorted[k - 1].h = x.h) OR (k < size(_sorted) - 1 AND _sorted[k + 1].h = x.h)), x -> x.i))"
        ),
    )
    covered = (
        f"aggregate(_at, named_struct('n', 0L, 'last', -{WINDOW}), "
        f"(a, i) -> named_struct('n', a.n + least({WINDOW}, i - a.last), 'last', i), a -> a.n)"
    )
    stop = F.filter("_ws", lambda w: F.lower(w).isin(STOP_WORDS))

    def only(characters: str) -> Column:
        return F.length(F.regexp_replace("_t", f"[^{characters}]++", ""))

    counts = {
        "n_words": F.size("_ws"),
        "word_chars": F.length(F.array_join("_ws", "")),
        "n_symbols": only(SYMBOLS),
        "n_dup_lines": F.size("_ls") - F.size(F.array_distinct("_ls")),
        "n_repeat_words": F.expr(covered),
        "n_lines": F.size("_ls"),
        "n_stop_words": F.size(stop),
        "n_exclamations": only("!"),
    }
    return passed, rows.select("_in", *[v.cast("bigint").alias(k) for k, v in counts.items()], F.monotonically_increasing_id().alias(ROW))


def measure_text(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the counts that rules use, all over the whole text (null: empty).

    Old columns of the names of counts and verdicts are replaced or left out.
    """
    passed, rows = _measured(docs, text)
    return rows.select(*unpacked(passed, "_in"), *COUNTS)


def apply_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` with the counts, ``base_failed``, ``failed_rules`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated windows. ``failed_rules``
    names the rules of the table that do not hold. A text is kept if neither applies; null and empty
    texts fail. Repeated rows are judged alike, an empty table gives an empty table. Other columns pass
    through; old columns of the result names (in any case) are replaced.
    """
    passed, out = _measured(docs, text)
    failed = [F.expr(f"if({r.holds()}, NULL, '{r.name}')") for r in rules]
    out = out.withColumn("base_failed", F.expr("n_words < 20 OR 100 * n_repeat_words > 30 * n_words"))
    out = out.withColumn("failed_rules", F.array_compact(F.array(*failed)))
    out = out.withColumn("kept", F.expr(f"NOT base_failed AND size(failed_rules) = 0 AND {ROW} >= 0"))
    return out.select(*unpacked(passed, "_in"), *COUNTS, *VERDICTS)


def rules_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The rule table as one SQL condition."""
    return " AND ".join(r.holds() for r in rules)
