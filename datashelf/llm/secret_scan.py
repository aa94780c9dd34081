"""Secrets in texts: regular expressions tried where an inverted index of trigrams says that they may match."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from datashelf.llm.common import few, keyed, stored
from datashelf.llm.trigrams import ALWAYS, candidates, postings, trigram_query


class Rule(NamedTuple):
    """Matches whose ``group`` has at least ``least`` characters are secrets of this kind."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules, then public formats of keys and tokens. No two alike, no look-around: any engine runs them.
BASE = [
    Rule(
        "assign",
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE = [
    Rule("aws_secret", r"""[aA][wW][sS]_?[sS][eE][cC][rR][eE][tT]_?([aA][cC][cC][eE][sS][sS]_?)?[kK][eE][yY]["']?\x20*[:=]\x20*["']?[A-Za-z0-9/+=]{40}"""),
    Rule("azure_key", r"AccountKey=[A-Za-z0-9+/]{40,}={0,2}"),
    Rule("basic_auth", r"[Bb]asic [A-Za-z0-9+/]{16,}={0,2}"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{16,}={0,2}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,400}\.eyJ[A-Za-z0-9_-]{8,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("pypi", r"pypi-[A-Za-z0-9_-]{32,}"),
    Rule("sendgrid", r"SG\.[A-Za-z0-9_-]{16,64}\.[A-Za-z0-9_-]{16,64}"),
    Rule("shopify", r"shp(at|ca|pa|ss)_[0-9a-fA-F]{32}"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("slack_hook", r"hooks\.slack\.com/services/[A-Za-z0-9/]{20,}"),
    Rule("ssh_key", r"ssh-(rsa|dss|ed25519) AAAA[A-Za-z0-9+/]{32,}={0,2}"),
    Rule("stripe", r"[prs]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("telegram", r"[0-9]{8,10}:AA[A-Za-z0-9_-]{33}"),
    Rule("url_password", r"://[^\x00-\x20/:@]{1,100}:[^\x00-\x20/@]{1,100}@"),
]
RULES = [*BASE, *MORE]


def _java(pattern: str) -> str:
    """For speed: no run of hexadecimal digits is tried again from its middle."""
    return rf"(?<![0-9a-f]){pattern}" if pattern.startswith("[0-9a-f]{") else pattern


def _spans(tried: DataFrame) -> DataFrame:
    """(row, kind, first, last) of the matches in rows of (row, text, kind, pattern, group, least).

    A text is split at the matches once; places are running sums over the lengths of what the splits left.
    """
    hits = F.expr("regexp_extract_all(text, pattern, 0)")
    values = F.expr("regexp_extract_all(text, pattern, group)")
    found = tried.withColumn("hits", hits).filter(F.size("hits") > 0)
    parts = F.slice(F.split("text", F.col("pattern"), -1), 1, F.size("hits"))
    at = F.posexplode(F.arrays_zip(parts.alias("part"), F.col("hits").alias("hit"), values.alias("value")))
    each = found.select("row", "kind", "least", at.alias("at", "m")).select(
        "row", "kind", "at", F.length("m.part").alias("before"), F.length("m.hit").alias("size"),
        (F.length("m.value") >= F.col("least")).alias("long"),
    )
    so_far = Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.sum(F.col("before") + F.col("size")).over(so_far)
    return each.select("row", "kind", (last - F.col("size")).alias("first"), last.alias("last"), "long").filter("long").drop("long")


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Matches of every rule: (row, doc_id, kind, first, last); code points from 0, ``last`` exclusive.

    Matches of a rule are leftmost and do not overlap; those of different rules may. The Boolean trigram query of each
    pattern is answered from an inverted index of the trigrams that the rules ask for, and the pattern is run on the texts
    found. Patterns without a trigram that every match must hold are run on all texts.

    Null and empty texts have no matches. Null ids and repeated rows are rows of their own. An empty table gives no rows.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    source = keyed(docs, id=id_col, text=text_col)
    texts = source.select("row", "text").filter(F.length("text") > 0)
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    asked = {kind: query for kind, query in queries.items() if query != ALWAYS}
    table = [(r.kind, _java(r.pattern), r.group, r.least) for r in rules]
    schema = "kind string, pattern string, group int, least int"

    found = []
    everywhere = [t for t in table if t[0] not in asked]
    if everywhere:
        each = F.explode(F.array(*[F.struct(*map(F.lit, t)) for t in everywhere])).alias("rule")
        tried = texts.select("row", "text", each).select(
            "row", "text", *[F.col(f"rule.col{i + 1}").alias(n) for i, n in enumerate(("kind", "pattern", "group", "least"))]
        )
        found.append(_spans(tried))
    if asked:
        vocabulary = sorted({t for query in asked.values() for alternative in query for t in alternative})
        index = stored(postings(texts, vocabulary), "postings")
        hits = stored(candidates(index, asked), "candidates")
        # a few dozen rules
        rule_table = F.broadcast(spark.createDataFrame([t for t in table if t[0] in asked], schema))
        tried = texts.join(few(hits), "row").join(rule_table, F.col("rule") == F.col("kind")).drop("rule")
        found.append(_spans(tried))
    spans = found[0] if len(found) == 1 else found[0].union(found[1])
    return spans.join(source.select("row", F.col("id").alias("doc_id")), "row").select("row", "doc_id", "kind", "first", "last")


def _listed(of: str) -> Column:
    return F.array_join(F.transform(F.array_sort(of), lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ",")


def secret_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """A row for each document: (row, doc_id, n_assign, n_access, n_hex, base_sha256, spans).

    ``spans`` lists all matches as ``kind:first:last``, by place, then in the order of the rules; ``base_sha256`` is the
    digest of the list of the base rules alone. See ``scan_secrets`` for nulls, repeated rows and empty tables.
    """
    source = keyed(docs, id=id_col)
    base = [r.kind for r in BASE]
    order = F.array_position(F.array(*[F.lit(r.kind) for r in rules]), F.col("kind"))
    span = F.struct("first", order.alias("order"), "last", "kind")
    is_base = F.col("kind").isin(base)
    told = (
        scan_secrets(docs, id_col=id_col, text_col=text_col, rules=rules)
        .groupBy("row")
        .agg(
            *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base],
            F.collect_list(span).alias("all"), F.collect_list(F.when(is_base, span)).alias("base"),
        )
        .select("row", *[f"n_{k}" for k in base], _listed("base").alias("base"), _listed("all").alias("spans"))
    )
    return source.join(told, "row", "left").select(
        "row", F.col("id").alias("doc_id"),
        *[F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in base],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"),
    )
