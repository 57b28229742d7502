"""URL filters by pattern rules that are indexed by their rarest literal token.

A rule is a host (with all its subdomains) and the beginning of a path, and is
run as a regular expression on host and path. Its literal tokens are the runs
of ASCII letters and digits that every fitting URL must have as whole tokens.
The rule is filed under the one of them that fewest URLs of the corpus have;
the tokens of a URL fetch its candidate rules, and only those run.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shipping import Shipped

TOKEN = re.compile("[A-Za-z0-9]+")
MAX_RULES = 1_000_000


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path as one, like ``example.org/es/``; the path starts at the first slash."""
    text: str
    verdict: str

    @property
    def pattern(self) -> str:
        return r"\A(?:[^/]*\.)?" + re.escape(self.text)

    @property
    def tokens(self) -> list[str]:
        """Tokens that a fitting URL has as whole tokens: the last one may go on in the URL."""
        return [m[0] for m in TOKEN.finditer(self.text) if m.end() < len(self.text)]


def with_host_and_path(pages: DataFrame) -> DataFrame:
    """Adds host (A-Z lower-cased) and path of ``url``: the host is what stands
    between the first ``://`` and the next ``/``, ``?`` or ``#``, the path from
    there to ``?`` or ``#``; both are empty without ``://`` or for null."""
    rest = F.when(F.locate("://", "url") > 0, F.expr("substring(url, locate('://', url) + 3)")).otherwise("")
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumn("rest", rest).withColumn(
        "host", F.translate(F.regexp_extract("rest", r"\A([^/?#]*)", 1), upper, lower)).withColumn(
        "path", F.regexp_extract("rest", r"\A[^/?#]*([^?#]*)", 1)).drop("rest")


def token_counts(pages: DataFrame, rules: list[Rule]) -> dict[str, int]:
    """URLs of the whole table that have each token of the rules (bounded by
    the rules: only their tokens are counted)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    own = F.array_distinct(F.regexp_extract_all(F.concat("host", "path"), F.lit("[A-Za-z0-9]+"), F.lit(0)))
    spark = pages.sparkSession
    # as a table, so that the plan doesn't grow with the rules
    table = F.broadcast(spark.createDataFrame([(t,) for t in wanted], "token string"))
    rows = pages.select(F.explode(own).alias("token")).join(table, "token").groupBy("token").count().collect()
    return {t: 0 for t in wanted} | {r["token"]: r["count"] for r in rows}


class RuleIndex:
    """Rules filed by their rarest token; rules without one are always candidates."""

    def __init__(self, rules: list[Rule], counts: dict[str, int]):
        self.by_token: dict[str, list[tuple[int, str, str, str]]] = {}
        for rule in dict.fromkeys(rules):
            home = min(rule.tokens, key=lambda t: (counts.get(t, 0), t), default="")
            self.by_token.setdefault(home, []).append((len(rule.text), rule.text, rule.verdict, rule.pattern))

    def judge(self, host: str, path: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest rule that fits; block wins a tie."""
        url, best = host + path, None
        for token in {"", *TOKEN.findall(url)}:
            for size, text, verdict, pattern in self.by_token.get(token, ()):
                if (best is None or (size, verdict) > best[::2]) and re.match(pattern, url):
                    best = (size, text, verdict)
        return (best[1], best[2]) if best else (None, None)


def _judge(shared, names: list[str], default: str):
    def judge(batches):
        index = shared.value
        for batch in batches:
            found = [index.judge(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
            columns = [batch.column(n) for n in names]
            columns += [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] or default for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "rule", "verdict"])
    return judge


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict per row of pages (page_id, url).

    A rule fits its host and all subdomains of it if the path starts with the
    rule's path; the longest fitting rule wins and gives the verdict; where
    none fits, rule is null and the verdict is ``default``. Null and
    malformed URLs have an empty host and path. The rules are a list of at
    most MAX_RULES (checked), sent to the executors once. Repeated rows give
    repeated rows; other columns are ignored; an empty table gives no rows.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; the index is for at most {MAX_RULES}: judge them in parts")
    parts = with_host_and_path(pages.select("page_id", "url")).select("page_id", "host", "path")
    shared = Shipped(pages.sparkSession, RuleIndex(rules, token_counts(parts, rules)))
    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return parts.mapInArrow(_judge(shared, ["page_id", "host", "path"], default), schema)
