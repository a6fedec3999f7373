"""Allow or block web addresses: rules first, then a logistic regression on hashed character n-grams.

The model is learned from a small table of labelled addresses. Where there is none, addresses that a rule decides make
one: the rules say which addresses are wanted, the model carries that over to addresses that no rule covers.

Defined results: a null address, or one without `://`, has an empty host and path, fits no rule and is judged by the
model. With no labelled address at all every address gets 0.5, which allows it. Repeated rows are judged alike and kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starling.llm.arrays import BYTE, mix, rolling

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GRAMS = (3, 4, 5)
BITS = 15
MAX_LABELLED = 4000
ALLOW, BLOCK = "allow", "block"


class Rule(NamedTuple):
    """Fits a host, its subdomains, and paths that start with path."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


def with_address(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add host (A-Z lower-cased) and path; of a column of the same name only the new one stays."""
    at = F.instr(pages[url], "://")
    rest = F.when(at > 0, F.substring(pages[url], at + 3, F.length(pages[url])))
    part = lambda i: F.coalesce(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", i), F.lit(""))
    return pages.withColumns({"host": F.translate(part(1), UPPER, LOWER), "path": part(2)})


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as text; null if none does. Of equally long ones a blocking rule wins."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), r.verdict == BLOCK, str(r))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(str(rule))).otherwise(found)
    return found


def verdict_of(rule: Column, rules: Sequence[Rule]) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == str(r), F.lit(r.verdict)).otherwise(out)
    return out


def labelled_by_rules(pages: DataFrame, rules: Sequence[Rule], most: int = MAX_LABELLED) -> DataFrame:
    """host, path and label (1: allowed) of at most `most` different addresses that a rule decides, by a hash of them."""
    known = with_address(pages).select("host", "path", rule_of(F.col("host"), F.col("path"), rules).alias("rule"))
    known = known.filter("rule IS NOT NULL").distinct()
    known = known.withColumn("label", (verdict_of(F.col("rule"), rules) == ALLOW).cast("int"))
    return known.orderBy(F.xxhash64("host", "path"), "host", "path").limit(most).select("host", "path", "label")


def features(hosts: Sequence[str], paths: Sequence[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams, and where those of each address begin (one more entry than addresses)."""
    texts = [f"\x02{h}\x03{p}\x04".encode() for h, p in zip(hosts, paths, strict=True)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    buckets, owners = [], []
    for n in GRAMS:
        hashes = rolling(BYTE[data], n)
        whole = np.flatnonzero(owner[: len(hashes)] == owner[n - 1 :]) if len(hashes) else np.empty(0, np.int64)
        buckets.append((mix(hashes[whole] + np.uint64(n)) >> np.uint64(64 - bits)).astype(np.int64))
        owners.append(owner[whole])
    buckets, owners = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return buckets[order], np.searchsorted(owners[order], np.arange(len(texts) + 1))


def _margins(weights: np.ndarray, bias: float, buckets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(weights[buckets])])
    count = np.diff(bounds)
    return bias + (total[bounds[1:]] - total[bounds[:-1]]) / np.sqrt(np.maximum(count, 1))


def fit(table: DataFrame, bits: int = BITS, rounds: int = 200, rate: float = 0.5, decay: float = 1e-4):
    """Weights and bias of the regression from host, path and label. The table is small: at most MAX_LABELLED rows."""
    rows = table.orderBy("host", "path").toPandas()
    weights, bias = np.zeros(1 << bits), 0.0
    if not len(rows):
        return weights, bias
    buckets, bounds = features(rows["host"], rows["path"], bits)
    label, count = rows["label"].to_numpy(float), np.diff(bounds)
    share = np.repeat(1 / np.sqrt(np.maximum(count, 1)), count)
    seen, seen_bias = np.full(1 << bits, 1e-8), 1e-8
    for _ in range(rounds):
        error = (1 / (1 + np.exp(-_margins(weights, bias, buckets, bounds))) - label) / len(label)
        slope = np.bincount(buckets, np.repeat(error, count) * share, 1 << bits) + decay * weights
        seen, seen_bias = seen + slope**2, seen_bias + error.sum() ** 2
        weights = weights - rate * slope / np.sqrt(seen)
        bias -= rate * error.sum() / np.sqrt(seen_bias)
    return weights, bias


def url_filter(pages: DataFrame, rules: Sequence[Rule], table: DataFrame | None = None) -> DataFrame:
    """Add host, path, rule, score (of the model, 1: allow) and verdict to every page."""
    weights, bias = fit(labelled_by_rules(pages, rules) if table is None else table)
    weights = weights.astype(np.float32)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in parts:
            yield pd.Series(1 / (1 + np.exp(-_margins(weights, bias, *features(hosts, paths)))))

    judged = with_address(pages)
    judged = judged.withColumn("rule", rule_of(judged["host"], judged["path"], rules))
    judged = judged.withColumn("score", score("host", "path"))
    model = F.when(F.col("score") >= 0.5, ALLOW).otherwise(BLOCK)
    return judged.withColumn("verdict", F.coalesce(verdict_of(F.col("rule"), rules), model))
