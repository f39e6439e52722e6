"""URL verdicts: a few host-and-path rules, and for all other URLs a logistic regression.

The regression works on hashed character n-grams of host and path and is trained from a small labelled URL table: any
table of (url, label), of which at most ``LABELLED`` distinct URLs are taken in order of their hash, or the short one
below. The labelled table is the only thing that reaches the driver; scoring is one pass without a shuffle, so hot hosts
do not matter.

Defined cases: host and path are what the rules say they are (host: after the first ``://`` up to ``/``, ``?``, ``#`` or
the end, A-Z in lower case; path: from there up to ``?``, ``#`` or the end); a NULL url or one without ``://`` has both
empty, fits no rule and is judged by the regression as an empty URL. Of rules that fit, the longest wins. Without a
labelled URL every score is 0.5, and a score up to 0.5 allows. Repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulseframe.llm.common import mix

ALLOW, BLOCK = "allow", "block"
# The rules (verdict, host/path).
RULES = (
    (ALLOW, "org/"),
    (BLOCK, "example.org/es/"),
    (BLOCK, "example.org/en/1"),
    (ALLOW, "com/fr/"),
    (BLOCK, "com/de/"),
)
# The small labelled table (verdict, URLs).
SEED_URLS = {
    BLOCK: """
        http://casino-royal.example.com/slots/bonus     https://www.mega-casino.example.net/en/771
        https://play-poker.example.com/en/1             http://m.online-bets.example.org/fr/20.html
        https://sports-bets.example.net/odds?page=3     https://www.best-bets.example.com/de/515
        http://jackpot-win.example.com/es/77/           https://win-lottery.example.net/en/9021
        https://blog.discount-pills.example.com/en/4    http://pills-online.example.org/fr/8812.html
        https://cheap-viagra.example.com/buy            https://cheap-pharmacy.example.net/de/31/
        http://www.adult-video.example.com/en/66        https://adult-chat.example.net/fr/5410
        https://xxx-cams.example.com/es/12              http://m.hot-x.example.org/en/800.html
        https://spam-links.example.com/en/19            http://link-farm.example.net/de/2377
        https://www.seo-farm.example.com/fr/41/         https://ads-server.example.com/en/3
        http://ad-track.example.net/en/610?ref=x        https://m.click-track.example.com/de/95
        https://track-ads.example.org/es/7002           http://free-downloads-crack.example.com/en/14
        https://free-warez.example.net/fr/230           https://payday-loans.example.com/en/58.html
        http://replica-watches.example.net/de/17        https://free-prize-win.example.com/es/440
    """.split(),
    ALLOW: """
        https://news.example.com/en/2041                http://www.library.example.org/fr/88.html
        https://university.example.net/de/7120/         https://m.weather.example.com/es/35
        http://city-council.example.org/en/912          https://blog.gardening.example.com/en/5.html
        https://museum.example.net/fr/6044?page=2&ref=x http://recipes.example.com/de/301#top
        https://science.example.org/es/1180             https://www.history.example.net/en/27/
        http://music-school.example.com/fr/450          https://health-service.example.org/en/19
        https://m.train-times.example.net/de/8          http://mountain-club.example.com/es/2290.html
        https://docs.example.org/en/73                  https://blog.astronomy.example.net/fr/515
        http://river-walks.example.com/en/3308/         https://teachers.example.org/de/64?utm_source=feed
        https://www.theatre.example.com/es/906          http://open-data.example.net/en/12.html
        https://bird-watch.example.org/fr/7             https://handbook.example.com/en/4471?page=2&ref=x
        http://stationery.example.net/de/520            https://m.thesaurus.example.com/en/39#top
        https://northern-lights.example.net/es/61       http://blog.knitting.example.org/en/8205
        https://www.translation.example.com/fr/14       https://other-stories.example.net/en/700
    """.split(),
}
# The labelled table: at most so many URLs. The model: n-gram lengths, hashed features, training steps and weight decay.
LABELLED = 4000
NGRAMS = (2, 3, 4, 5)
FEATURES = 1 << 15
STEPS, RATE, DECAY = 300, 2.0, 1e-4


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule whose host is ``host`` or a parent domain and whose path begins ``path``, else NULL."""
    found = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, slash, below = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + below))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    verdict = F.lit(None).cast("string")
    for name, text in rules:
        verdict = F.when(rule == text, F.lit(name)).otherwise(verdict)
    return verdict


def parts(urls: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path and rule of every URL."""
    split = urls.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"))
    return split.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))


def features(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, with marks at their ends."""
    found = []
    for seed, part in ((1, f"\x02{host}\x03"), (2, f"\x02{path}\x03")):
        codes = np.frombuffer(part.encode("utf-32-le"), "<u4").astype("u8")
        for n in NGRAMS:
            if len(codes) >= n:
                grams = np.full(len(codes) - n + 1, seed * 16 + n, "u8")
                for k in range(n):
                    grams = mix(grams * np.uint64(0x9E3779B97F4A7C15) + codes[k:len(codes) - n + 1 + k])
                found.append(grams)
    return np.unique(np.concatenate(found) % np.uint64(FEATURES)).astype("i8") if found else np.zeros(0, "i8")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30.0, 30.0)))


@dataclass
class UrlModel:
    """Logistic regression; ``score`` is the probability of a blocked URL."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    bias: float = 0.0

    def score(self, host: str, path: str) -> float:
        at = features(host, path)
        return float(sigmoid(np.array(self.bias + self.weights[at].sum() / np.sqrt(max(1, len(at))))))


def train(rows: Sequence[tuple[str, str, int]]) -> UrlModel:
    """Fit a model to (host, path, 1 if blocked) rows; the two labels weigh the same."""
    model = UrlModel()
    labels = np.array([label for _, _, label in rows], "f8")
    if not len(rows) or labels.min() == labels.max():
        return model
    found = [features(host, path) for host, path, _ in rows]
    sizes = np.array([len(f) for f in found])
    at, row = np.concatenate(found), np.repeat(np.arange(len(rows)), sizes)
    scale = 1.0 / np.sqrt(np.maximum(1, sizes))
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    for _ in range(STEPS):
        margin = model.bias + np.bincount(row, model.weights[at], len(rows)) * scale
        slope = (sigmoid(margin) - labels) * weight
        gradient = np.bincount(at, (slope * scale)[row], FEATURES)
        model.weights -= RATE * (gradient * 10 + DECAY * model.weights)
        model.bias -= RATE * slope.sum()
    return model


def seed_urls(spark: SparkSession) -> DataFrame:
    """The fixed labelled table: url and label (1 if blocked)."""
    rows = [(url, int(verdict == BLOCK)) for verdict, urls in SEED_URLS.items() for url in urls]
    return spark.createDataFrame(rows, "url string, label int")


def fitted(labelled: DataFrame, limit: int = LABELLED) -> UrlModel:
    """A model of a labelled table; of more than ``limit`` distinct URLs, the first in order of their hash are taken."""
    split = labelled.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label")
    chosen = split.where("label IS NOT NULL").distinct().orderBy(F.xxhash64("host", "path"), "host", "path", "label")
    return train([(r["host"], r["path"], r["label"]) for r in chosen.limit(limit).collect()])


def judge(urls: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """page_id, host, path, rule, score and verdict of every URL."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            scores = pa.array([model.score(h, p) for h, p in zip(hosts, paths, strict=True)], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("page_id", "host", "path", "rule")), scores],
                names=["page_id", "host", "path", "rule", "score"],
            )

    scored = parts(urls, rules).mapInArrow(work, "page_id long, host string, path string, rule string, score double")
    by_score = F.when(F.col("score") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return scored.withColumn("verdict", F.coalesce(rule_verdict(F.col("rule"), rules), by_score))


def judge_pages(pages: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Judge every page with a model of ``labelled``, by default of the fixed table."""
    return judge(pages, fitted(seed_urls(pages.sparkSession) if labelled is None else labelled))
