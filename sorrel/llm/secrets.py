"""Secret scans: a trigram index says which documents a rule can match at all, and only those are searched."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sorrel.llm.common import documents
from sorrel.llm.trigrams import query_of, trigrams_of


@dataclass(frozen=True)
class Rule:
    """A pattern; a match counts if group `value` has at least `least` characters."""

    kind: str
    pattern: str
    value: int = 0
    least: int = 1

    @property
    def query(self):
        """The Boolean trigram query that the pattern implies (see `trigrams`), or None: every document may match."""
        return query_of(self.pattern)


#: The base rules, in the order in which spans at one place are listed, and the added ones after them.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", value=2, least=12),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
ADDED = (
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("bearer", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
_SPAN = "struct<start: bigint, kind: int, end: bigint>"


def trigram_index(docs: DataFrame, trigrams: list[str], block_docs: int = 4096) -> DataFrame:
    """(block, postings) for each block of documents: a map from trigram to the sorted ids of the block's documents that hold it, in any case.

    Only trigrams that a rule asks for are indexed. A block is a hash range of about `block_docs` ids, so no posting list grows with the corpus.
    """
    n = max(1, -(-docs.count() // block_docs))
    low = F.lower(F.col("text").cast("string"))
    held = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), low.alias("low"))
    held = held.select("doc_id", F.explode(F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))).alias("trigram"))
    held = held.select(F.pmod(F.xxhash64("doc_id"), F.lit(n)).alias("block"), "trigram", "doc_id").repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "block")
    lists = held.groupBy("block", "trigram").agg(F.sort_array(F.collect_set("doc_id")).alias("ids"))
    return lists.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("postings"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, rules): numbers of the rules that each document may match, by intersecting posting lists. Rules without a query aren't listed."""
    asked = {i: r.query for i, r in enumerate(rules) if r.query is not None}
    if not asked:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.array().cast("array<int>").alias("rules")).where("false")
    index = trigram_index(docs, sorted(set().union(*map(trigrams_of, asked.values()))))
    none = F.array().cast("array<bigint>")

    def answer(query) -> Column:
        if isinstance(query, str):
            return F.coalesce(F.try_element_at("postings", F.lit(query)), none)
        return reduce(F.array_intersect if query[0] == "and" else F.array_union, map(answer, query[1]))

    found = index.select(F.explode(F.array(*[F.struct(F.lit(i).alias("rule"), answer(q).alias("ids")) for i, q in asked.items()])).alias("x"))
    return found.select("x.rule", F.explode("x.ids").alias("doc_id")).groupBy("doc_id").agg(F.collect_set("rule").alias("rules"))


def _spans(rule: Rule, number: int, may: str) -> str:
    """SQL for the rule's spans in `_text`, empty where `may` is false. Matches and the text between them give the places."""
    pattern = "r'" + rule.pattern.replace("'", r"\x27") + "'"
    value = f"regexp_extract_all(_text, {pattern}, {rule.value})"
    parts = f"arrays_zip(regexp_extract_all(_text, {pattern}, 0), split(_text, {pattern}, -1), {value})"
    step = f"(a, x) -> named_struct('at', a.at + length(x.`1`) + length(x.`0`), 'out', if(length(x.`2`) >= {rule.least}, concat(a.out, array(named_struct('start', a.at + length(x.`1`), 'kind', {number}, 'end', a.at + length(x.`1`) + length(x.`0`)))), a.out))"
    zero = f"named_struct('at', 0L, 'out', cast(array() as array<{_SPAN}>))"
    return f"if({may} and _text rlike {pattern}, aggregate(filter({parts}, x -> x.`0` is not null), {zero}, {step}, a -> a.out), cast(array() as array<{_SPAN}>))"


def scan(docs: DataFrame, base: tuple[Rule, ...] = BASE, added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """All columns of `docs` with base_spans and spans: arrays of (start, kind number, end), in code points, end exclusive, by start, then kind.

    Each rule's Boolean trigram query is derived from its pattern and answered by the index; rules without a mandatory trigram search all texts. Candidates are verified with
    the pattern, leftmost and without overlaps within a kind. Spans of `added` rules come on top of the base ones.

    Null texts are empty. Rows with a null doc_id aren't in the index and so are searched for every rule. Rows that share an id are searched for what any of them may match. Columns of `docs`
    that bear a name of the result's are replaced; an empty table gives an empty result.
    """
    rules = base + added
    own = [c for c in docs.columns if c not in ("base_spans", "spans")]
    # the documents' columns travel in one struct, so their names meet no others
    rows = docs.select(F.struct(*own).alias("row"), F.col("doc_id").cast("long").alias("_key"))
    may = candidates(docs, rules)
    rows = rows.join(may, rows["_key"] == may["doc_id"], "left").withColumns({"_rules": F.coalesce("rules", F.array().cast("array<int>")), "_text": F.coalesce(F.col("row.text").cast("string"), F.lit(""))})
    for i, r in enumerate(rules):
        rows = rows.withColumn(f"_s{i}", F.expr(_spans(r, i, f"(_key is null or array_contains(_rules, {i}))" if r.query is not None else "true")))
    spans = [F.array_sort(F.concat(*[f"_s{i}" for i in range(n)])).alias(name) for name, n in (("base_spans", len(base)), ("spans", len(rules)))]
    return rows.select("row", *spans).select(*[F.col("row").getField(c).alias(c) for c in own], "base_spans", "spans")


def _written(column: str, rules: tuple[Rule, ...]):
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", F.get(kinds, x["kind"]), x["start"], x["end"])), ",")


def op2_trigram_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir).select("doc_id", "text"))

    def count(kind: int):
        return F.size(F.filter("base_spans", lambda x: x["kind"] == kind)).cast("long")

    counts = [count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_written("base_spans", BASE), 256).alias("base_sha256"), _written("spans", BASE + ADDED).alias("spans"))


def _op2_sql() -> str:
    def spans(r: Rule, i: int) -> str:
        p = r.pattern.replace("(?i:", "").replace("))", ")", 1).replace("'", "''")
        if r.kind == "assign":
            p = "".join(f"[{c.upper()}{c}]" if c.isalpha() and at < p.index(")[") else c for at, c in enumerate(p))
        m, g, v = f"regexp_extract_all(t, '{p}', 0)", f"regexp_split_to_array(t, '{p}')", f"regexp_extract_all(t, '{p}', {r.value})"
        return f"""SELECT doc_id, {i} AS kind, '{r.kind}' AS name, start, start + len AS stop FROM (
          SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda k: list_sum(list_transform(g[1:k], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:k - 1], lambda x: length(x))), 0)))::BIGINT AS start,
                 unnest(list_transform(m, lambda x: length(x))) AS len, unnest(list_transform(v, lambda x: length(x))) AS size
          FROM (SELECT doc_id, {m} AS m, {g} AS g, {v} AS v FROM docs)) WHERE size >= {r.least}"""

    rules = BASE + ADDED
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
spans AS ({" UNION ALL ".join(spans(r, i) for i, r in enumerate(rules))}),
joined AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE kind = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))},
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (WHERE kind < {len(BASE)}) AS base,
         string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
  FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""


OP2_SQL = _op2_sql()
