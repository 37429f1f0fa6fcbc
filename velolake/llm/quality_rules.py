"""Quality rules: a table of thresholds compiled into Spark projections.

``measures`` gives the counts that the rules need, ``RATIOS`` the ratios
formed of them, ``RULES`` the thresholds.  ``verdict`` compiles the table to
one Boolean expression.  Everything is built of Spark's own functions; no
row leaves the JVM and nothing is shuffled.

Words are runs of characters other than space, tab, line feed, vertical tab,
form feed and carriage return.  A word is repeated if a window of eight
words that holds it occurs twice or more in the text.  Windows are compared
by a 64-bit hash of their words' 64-bit hashes.

Defined cases: a null text has no words, fails the base rule and is not
kept; ratios with no words are null and reject nothing by themselves; any
length of text is measured whole; rows are judged alone, so ties and repeats
are no matter; other columns pass through ``measured``, those whose names
clash with the new ones give way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velolake.llm.common import replaced

WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

# Frequent function words of English, French, German, Spanish.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it of on or that the this to was were will with "
    "au aux avec ce dans de des du elle en est et il la le les mais ne nous ou par pas pour qui que se sur un une "
    "als auch auf aus bei das dem den der die ein eine er es für im ist mit nach nicht sich sie und von war wie zu "
    "al como con del el ella esta este las lo los no para pero por se su una y"
).split()

#: name, numerator, denominator
RATIOS = (
    ("mean_word_chars", "word_chars", "n_words"),
    ("symbol_ratio", "n_symbols", "n_words"),
    ("dup_line_ratio", "n_dup_lines", "n_lines"),
    ("repeat_word_ratio", "n_repeat_words", "n_words"),
    ("stop_word_ratio", "n_stop_words", "n_words"),
    ("letter_ratio", "n_letters", "word_chars"),
    ("upper_ratio", "n_upper", "n_letters"),
)

#: measure or ratio, least, most (None: no bound)
RULES = (
    ("n_words", 20, None),
    ("mean_word_chars", 2.0, 15.0),
    ("symbol_ratio", None, 0.25),
    ("dup_line_ratio", None, 0.5),
    ("repeat_word_ratio", None, 0.3),
    ("stop_word_ratio", 0.02, None),
    ("letter_ratio", 0.6, None),
    ("upper_ratio", None, 0.6),
)


def _removed(text: Column, characters: str) -> Column:
    """Text without a class of characters (the class in brackets)."""
    return F.regexp_replace(text, f"[{characters}]+", "")


def _added(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select("*", *[c.alias(k) for k, c in columns.items()])


def repeated_words(df: DataFrame, hashes: str, n: str, window: int = WINDOW) -> DataFrame:
    """``df`` with ``n_repeat_words`` of the array ``hashes`` of ``n`` words.

    Only texts whose windows are not all distinct are looked at closely:
    their windows are sorted with their places, neighbours that are equal
    mark places, and the marked stretches are added up.  That takes
    n log n steps for a text of n words."""
    h, at = F.col(hashes), F.col("_at")
    made = _added(df, {"_w": F.when(
        F.col(n) >= window, F.transform(F.sequence(F.lit(1), F.col(n) - (window - 1)), lambda i: F.xxhash64(F.slice(h, i, F.lit(window))))
    )})
    some = F.size(F.array_distinct("_w")) < F.size("_w")
    made = _added(made, {"_s": F.when(some, F.sort_array(F.transform("_w", lambda x, i: F.struct(x.alias("h"), i.alias("p")))))})
    same = lambda x, i, d: F.coalesce(F.get(F.col("_s"), i + d)["h"] == x["h"], F.lit(False))
    made = _added(made, {"_at": F.sort_array(F.transform(F.filter("_s", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["p"]))})
    # each marked window covers its words up to the next marked window
    step = lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(window)), F.lit(window))
    covered = F.aggregate(F.transform("_at", step), F.lit(0), lambda a, x: a + x)
    return _added(made, {"n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long")}).drop("_w", "_s", "_at")


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the measures and ratios of its texts; its columns of
    these names give way, those of any other name stay."""
    # its columns are one while the measures are made: no name can clash
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    made = df.select(whole.alias("_record"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    t = F.col("_t")
    words = F.filter(F.split(F.translate(t, SPACES[1:], " " * (len(SPACES) - 1)), " ", -1), lambda w: w != "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    made = _added(made, {"_words": words, "_lines": lines})
    made = _added(made, {"_h": F.transform("_words", lambda w: F.xxhash64(w)), "_n": F.size("_words"), "_solid": _removed(t, SPACES)})
    made = repeated_words(made, "_h", "_n")
    counts = {
        "n_words": F.col("_n"),
        "word_chars": F.length("_solid"),
        "n_symbols": F.length(_removed(F.col("_solid"), "^" + SYMBOLS)),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.col("n_repeat_words"),
        "n_stop_words": F.size(F.filter("_words", lambda w: F.lower(w).isin(*STOP_WORDS))),
        "n_letters": F.length(_removed(F.col("_solid"), r"^\p{L}")),
        "n_upper": F.length(_removed(F.col("_solid"), r"^\p{Lu}")),
    }
    made = replaced(made, {k: c.cast("long") for k, c in counts.items()})
    made = replaced(made, {k: F.try_divide(F.col(a).cast("double"), F.col(b)) for k, a, b in RATIOS})
    own = [*counts, *[k for k, _, _ in RATIOS]]
    return made.select(*[F.col(f"_record.`{c}`").alias(c) for c in df.columns if c.lower() not in own], *own)


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them repeated."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def verdict(rules: tuple = RULES) -> Column:
    """The threshold table as one expression: no rule rejects the row."""
    failed = F.lit(False)
    for name, least, most in rules:
        value = F.col(name)
        bad = F.lit(False)
        if least is not None:
            bad = bad | (value < least)
        if most is not None:
            bad = bad | (value > most)
        failed = failed | F.coalesce(bad, F.lit(False))
    return ~failed


def judged(df: DataFrame, text: str = "text", rules: tuple = RULES) -> DataFrame:
    """``df`` with measures, ratios, ``base_failed`` and ``kept``."""
    return replaced(measured(df, text), {"base_failed": base_failed(), "kept": ~base_failed() & verdict(rules)})


def kept_rows(df: DataFrame, text: str = "text", rules: tuple = RULES) -> DataFrame:
    """The rows of ``df`` that the rules keep, with its columns alone."""
    whole = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), F.col(f"`{text}`").alias("text"))
    # not a filter: the optimiser would move it below the measures, with each
    # measure written out again wherever the rules name it
    return judged(whole, "text", rules).select(F.inline(F.when(F.col("kept"), F.array("whole"))))


def digest(documents: DataFrame) -> DataFrame:
    """Per document: the base measures and the verdict."""
    return judged(documents.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def oracle() -> str:
    """The digest in DuckDB's SQL, from the same threshold table."""
    letter, upper = r"\p{L}", r"\p{Lu}"
    space, word = r"[\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]+"
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    ratio = ", ".join(f"CASE WHEN {b} > 0 THEN {a}::DOUBLE / {b} END AS {k}" for k, a, b in RATIOS)
    bad = [f"{k} < {v}" for k, v, _ in RULES if v is not None] + [f"{k} > {v}" for k, _, v in RULES if v is not None]
    rejected = " OR ".join(f"coalesce({b}, false)" for b in bad)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '{word}') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines,
        regexp_replace(t, '{space}', '', 'g') AS solid FROM d),
p AS (SELECT rid, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS k
      FROM (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
s AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS n FROM p) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT i + j) AS n FROM s, range({WINDOW}) o(j) GROUP BY rid),
m AS (SELECT w.doc_id, len(words) AS n_words, length(solid) AS word_chars,
        length(regexp_replace(solid, '[^{SYMBOLS}]+', '', 'g')) AS n_symbols,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
        len(list_filter(words, lambda x: lower(x) IN ({stop}))) AS n_stop_words,
        length(regexp_replace(solid, '[^{letter}]+', '', 'g')) AS n_letters,
        length(regexp_replace(solid, '[^{upper}]+', '', 'g')) AS n_upper
      FROM w LEFT JOIN r USING (rid)),
q AS (SELECT *, {ratio}, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND NOT ({rejected}) AS kept FROM q"""
