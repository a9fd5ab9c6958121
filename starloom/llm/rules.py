"""Quality rules: a threshold table compiled into one projection.

The counts of a text (words, characters, symbols, lines, stop words, repeats)
are plain column expressions, worked out once per row and kept in one struct
with the verdict, so that a filter on the verdict, pushed below the projection, holds one copy of them.
Each rule of the table compares 100 * one count with a whole percentage of
another, so a verdict never depends on floating point. No user functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import let, text_of, word_array

SYMBOLS = "#*$%&|<>"
#: Frequent short words of English, German, French and Spanish (fixed values).
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "it", "that", "on", "for", "with", "was", "as", "are",
    "der", "die", "das", "und", "ist", "ein", "eine", "nicht", "von", "mit", "den", "zu", "im", "auf",
    "le", "la", "les", "de", "des", "et", "un", "une", "du", "que", "qui", "dans", "pour",
    "el", "los", "las", "y", "en", "por", "con", "una", "para", "se", "del",
)
#: A stop word counts in lower case and with a capital.
STOP_FORMS = tuple(dict.fromkeys(form for word in STOP_WORDS for form in (word, word.capitalize())))
_WINDOW = 8
#: Words of a block in which distinct words are counted.
BLOCK = 1000


@dataclass(frozen=True)
class Rule:
    """Fails where 100 * part < least * whole or 100 * part > most * whole."""

    name: str
    part: str
    whole: str
    least: int | None = None
    most: int | None = None


#: Verdicts of the method. No rule bounds the length of a text from above: distinct words, of
#: which a longer text has a smaller share, are counted per block of ``BLOCK`` words and added up.
RULES = (
    Rule("word_length", "word_chars", "n_words", least=200, most=1200),
    Rule("symbols", "n_symbols", "n_words", most=20),
    Rule("marks", "n_marks", "n_words", most=60),
    Rule("capitals", "n_capitals", "word_chars", most=60),
    Rule("stop_words", "n_stop_words", "n_words", least=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", most=50),
    Rule("distinct_words", "n_distinct_words", "n_words", least=8),
)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of eight words that occur twice or more in the text.

    A window is known by a 64-bit hash of its words. Most texts repeat none,
    which counting the distinct hashes shows; only the others sort their windows.
    """

    def covered(at: Column) -> Column:
        step = F.transform(
            at, lambda x, k: F.when(k == 0, _WINDOW).otherwise(F.least(F.lit(_WINDOW), x - F.get(at, k - 1)))
        )
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            placed,
            lambda p: let(
                F.sort_array(
                    F.transform(
                        F.filter(
                            p,
                            lambda x, k: F.coalesce(F.get(p, k - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False)),
                        ),
                        lambda x: x["i"],
                    )
                ),
                covered,
            ),
        )

    def of_windows(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(repeated(hashes))

    def joined(hashes: Column, step: int, windows: Column) -> Column:
        """Hashes of runs of 2 * step words from those of ``step`` words."""
        return F.slice(F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + step))), 1, windows)

    n = F.size(words)
    fours = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda ones: let(joined(ones, 1, n - 1), lambda twos: joined(twos, 2, n - 3)),
    )
    # a window that occurs again takes five runs of four words with it
    again = lambda f: F.size(f) - F.size(F.array_distinct(f)) >= 5
    return F.when(n <= _WINDOW, F.lit(0)).otherwise(
        let(fours, lambda f: F.when(again(f), let(joined(f, 4, n - 7), of_windows)).otherwise(F.lit(0)))
    )


def _distinct_words(words: Column) -> Column:
    """Distinct words of each block, added up."""
    blocks = F.sequence(F.lit(0), F.floor(F.greatest(F.size(words) - 1, F.lit(0)) / BLOCK).cast("int"))
    several = F.aggregate(
        blocks, F.lit(0), lambda n, k: n + F.size(F.array_distinct(F.slice(words, k * BLOCK + 1, BLOCK)))
    )
    return F.when(F.size(words) <= BLOCK, F.size(F.array_distinct(words))).otherwise(several)


def _occurrences(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def counts(text: Column) -> Column:
    """Struct of every count the rules may name; all are whole numbers."""

    def of_words(words: Column, lines: Column) -> Column:
        whole_lines = F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            whole_lines,
            lambda rows: F.struct(
                F.size(words).cast("long").alias("n_words"),
                (F.length(text) - _occurrences(text, r"[\x20\x09-\x0D]")).alias("word_chars"),
                _occurrences(text, f"[{SYMBOLS}]").alias("n_symbols"),
                _occurrences(text, "[!?]").alias("n_marks"),
                _occurrences(text, r"\p{Lu}").alias("n_capitals"),
                F.size(F.filter(words, lambda w: w.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
                _distinct_words(words).cast("long").alias("n_distinct_words"),
                F.size(rows).cast("long").alias("n_lines"),
                (F.size(rows) - F.size(F.array_distinct(rows))).cast("long").alias("n_dup_lines"),
                _repeat_words(words).cast("long").alias("n_repeat_words"),
            ),
        )

    return let(word_array(text), lambda words: of_words(words, F.split(text, "\n", -1)))


def base_failed(c: Column) -> Column:
    return (c["n_words"] < 20) | (c["n_repeat_words"] * 100 > c["n_words"] * 30)


def failures(c: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the rules that counts fail, in the order of the table."""

    def broken(rule: Rule) -> Column:
        tests = []
        if rule.least is not None:
            tests.append(c[rule.part] * 100 < c[rule.whole] * rule.least)
        if rule.most is not None:
            tests.append(c[rule.part] * 100 > c[rule.whole] * rule.most)
        failed = tests[0]
        for more in tests[1:]:
            failed = failed | more
        return F.when(failed, F.lit(rule.name))

    return F.array_compact(F.array(*map(broken, rules)))


def judgement(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct of counts, base_failed, failed and kept; the counts are bound once."""

    def verdict(c: Column) -> Column:
        return let(
            F.struct(base_failed(c).alias("base"), failures(c, rules).alias("failed")),
            lambda v: F.struct(
                c.alias("counts"),
                v["base"].alias("base_failed"),
                v["failed"].alias("failed"),
                (~v["base"] & (F.size(v["failed"]) == 0)).alias("kept"),
            ),
        )

    return let(counts(text), verdict)


def judge(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Counts and verdict of every text: id (unless kept), the ``keep`` columns, counts, base_failed, failed, kept.

    A null text counts as empty; an empty text has no words and fails. Repeated
    rows are judged row by row, an empty table gives an empty result. Only the
    named columns are read; an output name replaces an input column of that name.
    """
    read = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        *[F.col(f"`{c}`").alias(f"kept {i}") for i, c in enumerate(keep)],
        judgement(text_of(text_col), rules).alias("judged"),
    )
    return read.select(
        *([] if id_col in keep else [F.col("id").alias(id_col)]),
        *[F.col(f"`kept {i}`").alias(c) for i, c in enumerate(keep)],
        *[F.col(f"judged.{c}").alias(c) for c in ("counts", "base_failed", "failed", "kept")],
    )
