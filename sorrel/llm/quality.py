"""Quality rules: lines are judged first, then the document by how much of it is left."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import documents

#: A line of text ends in one of these, and maybe closing quotes or brackets.
TERMINAL = r"""[.!?:;。！？…]["'”’»)\]]{0,4}$"""
#: Signs that set the entries of menus, breadcrumbs and tag lists apart.
SEPARATOR = r"[|»›•·→]"
#: Signs that prose has few of.
SYMBOLS = r"[#*$%&|<>{}=~^_\\]"
#: Fixed list: phrases of notices that pages repeat (compared in lower case).
BOILERPLATE = ("lorem ipsum", "cookie policy", "privacy policy", "terms of use", "terms of service", "all rights reserved", "use of cookies", "enable javascript", "subscribe to our newsletter", "click here", "back to top", "skip to content")
_SPACE = r"[\x20\x09-\x0D]"

RESULT = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lines_failed", "lost_chars", "clean_text", "kept")


def _lines(text):
    return F.split(text, "\n", -1)


def _words(text):
    return F.expr(f"filter(split({text}, r'[\\x20\\x09-\\x0D]+', -1), x -> x != '')")


def base_measures(docs: DataFrame, text: str = "_text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the text column."""
    words = docs.withColumn("_words", _words(text))
    lines = F.filter(_lines(F.col(text)), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    # one hash for each word, then one for each two, four and eight in a row
    windows = words.withColumns({"_h": F.transform("_words", lambda w: F.xxhash64(w)), "_lines": lines})
    for at, step in (("_h", 1), ("_h2", 2), ("_h4", 4)):
        windows = windows.withColumn(f"_h{2 * step}", F.expr(f"transform({at}, (x, i) -> xxhash64(x, get({at}, i + {step})))"))
    windows = windows.withColumn("_w", F.expr("slice(_h8, 1, greatest(0, size(_h8) - 7))"))
    # places of windows found twice, in order: each covers eight words, or as many as there are before the next
    again = windows.withColumn("_s", F.expr("if(size(array_distinct(_w)) = size(_w), cast(array() as array<struct<h: bigint, i: int>>), array_sort(transform(_w, (h, i) -> struct(h, i))))"))
    places = again.withColumn("_at", F.expr("array_sort(transform(filter(_s, (x, j) -> (j > 0 and _s[j - 1].h = x.h) or (j < size(_s) - 1 and _s[j + 1].h = x.h)), x -> x.i))"))
    return places.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.regexp_replace(F.col(text), r"[#*$%&|<>]+", ""))).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.expr("aggregate(transform(_at, (p, j) -> if(j < size(_at) - 1, least(8, _at[j + 1] - p), 8)), 0L, (a, x) -> a + x)"),
    }).drop("_words", "_h", "_h2", "_h4", "_h8", "_w", "_s", "_at")


def _count(line, pattern: str):
    return F.length(line) - F.length(F.regexp_replace(line, pattern, ""))


def bad_line(line, may_be_boilerplate):
    """Whether a line with a word fails. Lines without a word pass.

    Punctuation: it doesn't end like a sentence; over a tenth of its characters are symbols; or it has four marks of `!` and `?` and one for each twelve characters. Navigation: three
    separators or more, with three words between them on average at most. Boilerplate: a phrase that pages repeat. Where a line has no such sign at all, nothing is counted.
    """
    bare = F.rtrim(line, F.lit(" \t\n\x0b\x0c\r"))
    chars = F.length(F.regexp_replace(line, _SPACE + "+", ""))
    words = F.size(F.filter(F.split(F.regexp_replace(line, SEPARATOR + "+", " "), _SPACE + "+", -1), lambda x: x != ""))
    separators, marks = _count(line, SEPARATOR + "+"), _count(line, "[!?]+")
    signs = line.rlike(r"[#*$%&|<>{}=~^_\\»›•·→]|[!?].*[!?]") & ((_count(line, SYMBOLS + "+") * 10 > chars) | ((separators >= 3) & (words <= 3 * (separators + 1))) | ((marks >= 4) & (marks * 12 > chars)))
    # the last five characters say how a line ends, and lines of texts without any such phrase aren't searched for one
    return line.rlike(r"[^\x20\x09-\x0D]") & (~F.right(bare, F.lit(5)).rlike(TERMINAL) | signs | (may_be_boilerplate & F.lower(line).rlike("|".join(BOILERPLATE))))


def judge(docs: DataFrame, min_words: int = 20, most_repeated: float = 30.0, most_lost: float = 50.0) -> DataFrame:
    """All columns of `docs` with the base measures, base_failed, lines_failed, lost_chars, clean_text and kept.

    Rules for punctuation, navigation and boilerplate are evaluated line by line and failing lines are removed (clean_text). A document is kept unless base_failed (fewer than
    `min_words` words, or over `most_repeated` % of them in windows of 8 words found twice) or the removed lines held over `most_lost` % of its word characters.
    Everything is a column expression of its own row: no shuffle, no skew.

    Null and empty texts have no words and fail. Repeated rows are judged alike. Columns of `docs` that bear a name of the result's are replaced; an empty table gives an empty result.
    """
    own = [c for c in docs.columns if c not in RESULT]
    # the documents' columns travel in one struct, so their names meet no others
    rows = base_measures(docs.select(F.struct(*own).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("_text")))
    # each line is judged once; a generated column, so that no use repeats it
    lines = F.transform(_lines(F.col("_text")), lambda x: F.struct(x.alias("line"), bad_line(x, F.col("_phrase")).alias("bad")))
    phrase = reduce(or_, [F.contains(F.lower("_text"), F.lit(x)) for x in BOILERPLATE])
    rows = rows.drop("_lines").withColumn("_phrase", phrase).select("*", F.explode(F.array(lines)).alias("_judged"))
    rows = rows.withColumn("_bad", F.filter("_judged", lambda x: x["bad"]))
    rows = rows.withColumn("clean_text", F.when(F.size("_bad") == 0, F.col("_text")).otherwise(F.array_join(F.filter("_judged", lambda x: ~x["bad"])["line"], "\n")))
    rows = rows.withColumn("lost_chars", F.length(F.regexp_replace(F.array_join(F.col("_bad")["line"], ""), _SPACE + "+", "")).cast("long"))
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    rows = rows.withColumns({"base_failed": failed, "lines_failed": F.size("_bad").cast("long")})
    rows = rows.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= most_lost * F.col("word_chars")))
    # generated columns: a filter on them stays above, and so doesn't repeat the measures within one another
    judged = rows.select("row", F.explode(F.array(F.struct(*RESULT))).alias("judged"))
    return judged.select(*[F.col("row").getField(c).alias(c) for c in own], "judged.*")


def op3_line_first_quality(spark, sf_dir: str) -> DataFrame:
    out = judge(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lines_failed", "lost_chars")


def _op3_sql() -> str:
    def counted(pattern: str) -> str:
        return f"(length(line) - length(regexp_replace(line, '{pattern}', '', 'g')))"

    space, terminal = r"[\x20\x09-\x0D]", TERMINAL.replace("'", "''")
    return rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '{space}+'), lambda x: x <> '') AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS p, w FROM docs WHERE len(w) >= 8),
hashed AS (SELECT doc_id, p, array_to_string(w[p:p + 7], ' ') AS g FROM windows),
twice AS (SELECT doc_id, p FROM hashed QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
repeated AS (SELECT doc_id, count(DISTINCT i) AS n FROM (SELECT doc_id, unnest(range(p, p + 8)) AS i FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs),
counted AS (SELECT *, regexp_replace(line, '{space}+$', '') AS bare, length(regexp_replace(line, '{space}+', '', 'g')) AS chars, {counted(SYMBOLS + "+")} AS symbols, {counted(SEPARATOR + "+")} AS separators, {counted("[!?]+")} AS marks,
  len(list_filter(regexp_split_to_array(regexp_replace(line, '{SEPARATOR}+', ' ', 'g'), '{space}+'), lambda x: x <> '')) AS words FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (SELECT *, NOT regexp_matches(bare, '{terminal}') OR symbols * 10 > chars OR (separators >= 3 AND words <= 3 * (separators + 1)) OR (marks >= 4 AND marks * 12 > chars) OR regexp_matches(lower(line), '{"|".join(BOILERPLATE)}') AS bad FROM counted),
per AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (WHERE bad) AS lines_failed, coalesce(sum(chars) FILTER (WHERE bad), 0) AS lost_chars FROM judged GROUP BY doc_id),
measured AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  coalesce(lines_failed, 0) AS lines_failed, coalesce(lost_chars, 0)::BIGINT AS lost_chars FROM docs d LEFT JOIN per ON d.doc_id = per.doc_id LEFT JOIN repeated r ON d.doc_id = r.doc_id)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept FROM measured
"""


OP3_SQL = _op3_sql()
