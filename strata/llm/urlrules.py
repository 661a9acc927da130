"""URL filters by a sort-merge range join.

A host is reversed (``blog.example.org`` to ``org.example.blog``), so that its
domain comes first. A rule (host, path) then fits a url if the url's reversed
host begins with the labels of the rule's and its path with the rule's path. For
each number of labels that any rule has, a url gets one key: that many labels, a
zero byte, the path. Among keys with one label count a rule is the interval of
strings that begin with its own key, and intervals are nested or disjoint.

Keys and rules meet on their labels, are sorted, and one sweep over the sorted
rows keeps a stack of the rules that are still open; its top is the longest that
fits. Labels with more than their share of urls (``org`` may fit a third of
them) are split by a hash of the row; their rules go to each part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import small_batches, staged

#: A label group is split into parts of this share of all keys at most.
PARTS = 256
#: Different numbers of labels among the rules, of which each url gets a key.
DEPTHS = 254


def host_and_path(url):
    """Columns (host, path). Host: after the first ``://`` up to ``/``, ``?``, ``#``
    or the end, A-Z lower-cased; path: from there up to ``?``, ``#`` or the end.
    Both are empty for null and for a url without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))).otherwise(F.lit(""))
    whole = F.regexp_extract(after, r"^[^?#]*", 0)
    host = F.regexp_extract(whole, r"^[^/]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(F.substr(whole, F.length(host) + F.lit(1)), F.lit(""))


def _labels(host):
    return F.reverse(F.split(host, r"\.", -1))


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (labels, part, path, is_url, row, rule, verdict), sorted so that a rule
    comes before the urls that its key begins: the longest open rule of each url."""
    group, stack = None, []
    for batch in batches:
        rows, rules, verdicts = [], [], []
        for labels, part, path, is_url, row, rule, verdict in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (labels, part) != group:
                group, stack = (labels, part), []
            while stack and not path.startswith(stack[-1][0]):
                stack.pop()
            if not is_url:
                if not stack or stack[-1][0] != path:  # of equal rules the first stays
                    stack.append((path, rule, verdict))
            elif stack:
                rows.append(row)
                rules.append(stack[-1][1])
                verdicts.append(stack[-1][2])
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(rules, pa.string()), pa.array(verdicts, pa.string())], names=["row", "rule", "verdict"])


def rule_table(docs: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A rule table (verdict, host, path) from a list."""
    return docs.sparkSession.createDataFrame(list(rules), "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """The verdict on every url.

    ``rules``: verdict, host, path. A rule fits its host and all subdomains if
    the url's path starts with its own. The longest wins: most characters in
    host and path together, then the longer host; of equal rules ``block``
    before ``allow``. Rules with a null are left out; rules with more than
    ``DEPTHS`` different numbers of labels are refused.

    Returns one row per page: ``id_col``, ``host``, ``path``, ``rule`` (host and
    path of the winner, or null) and ``verdict`` (the rule's, else
    ``otherwise``). A null or malformed url has an empty host, which no rule
    fits. Null and repeated ids pass through, further columns aren't read, empty
    tables give no rows (no rules: every url is judged ``otherwise``).
    """
    spark = pages.sparkSession
    small_batches(spark, 4096)
    host, path = host_and_path(F.col(url_col))
    urls = pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = staged(urls, "urls")
    rules = rules.where("host <> '' AND path IS NOT NULL AND verdict IS NOT NULL").select("verdict", F.lower("host").alias("host"), "path")
    rules = rules.select("verdict", "path", _labels(F.col("host")).alias("l"), F.concat("host", "path").alias("rule"))
    rules = staged(rules.select("verdict", "path", F.concat_ws(".", "l").alias("labels"), F.size("l").alias("depth"), "rule"), "rules")

    depths = [r.depth for r in rules.select("depth").distinct().orderBy("depth").limit(DEPTHS + 1).collect()]
    if len(depths) > DEPTHS:
        raise ValueError(f"rules with over {DEPTHS} different numbers of labels; a host name has 127 labels at most")
    reversed_ = _labels(F.col("host"))
    keys = urls.where("host <> ''").select("row", "path", reversed_.alias("l"))
    known = F.array(*map(F.lit, depths)) if depths else F.array().cast("array<int>")
    keys = keys.select("row", "path", "l", F.explode(known).alias("depth")).where("depth <= size(l)")
    keys = keys.select("row", "path", F.concat_ws(".", F.slice("l", F.lit(1), F.col("depth"))).alias("labels"))
    keys = staged(keys.join(rules.select("labels").distinct(), "labels", "left_semi"), "keys")

    # groups above their share of the keys: PARTS of them at most, so they can be broadcast
    share = -(-max(1, keys.count()) // PARTS)
    hot = keys.groupBy("labels").agg(F.count("*").alias("c")).where(F.col("c") > share).select("labels", F.ceil(F.col("c") / share).cast("int").alias("parts"))
    hot = F.broadcast(hot)
    dealt = keys.join(hot, "labels", "left").withColumn("part", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).cast("int"))
    spread = rules.join(hot, "labels", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
    none = F.lit(None).cast("string")
    events = dealt.select("labels", "part", "path", F.lit(True).alias("is_url"), "row", none.alias("rule"), none.alias("verdict")).unionByName(
        spread.select("labels", "part", "path", F.lit(False).alias("is_url"), F.lit(None).cast("long").alias("row"), "rule", "verdict")
    )
    order = ["labels", "part", "path", "is_url", F.col("verdict").desc()]  # block before allow
    events = events.repartition("labels", "part").sortWithinPartitions(*order)
    found = events.mapInArrow(_sweep, "row long, rule string, verdict string")
    host_end = F.coalesce(F.nullif(F.instr("rule", "/"), F.lit(0)), F.length("rule") + 1)
    size = F.struct(F.length("rule").alias("size"), host_end.alias("host"), "rule", "verdict")  # the longest over all label counts
    best = found.groupBy("row").agg(F.max(size).alias("best")).select("row", "best.rule", "best.verdict")
    out = urls.join(best, "row", "left")
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict"))
