"""URL filtering: explicit rules first, then logistic regression on hashed character n-grams of host and path.

Defined results: a null URL or one without ``://`` has empty host and path, fits no rule and is judged by the model; URLs
of any length are read whole; of rules of one length that fit, the first by its text wins; repeated rows get equal
results; a column of the input named like an output stays, and the output's name gets an underscore (``host_``); an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterframe.llm.common import append_columns, blocks, code_points, free_name, ngram_buckets

BITS = 14
ORDERS = (3, 4, 5)

#: (verdict, host, path).
DEFAULT_RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: The labelled URLs that the model learns from: 1 is unwanted.
LABELLED_URLS = (
    ("https://www.city-library.example.org/en/catalogue/1204", 0), ("http://news.daily.example.com/en/politics/8812.html", 0),
    ("https://blog.gardener.example.org/2021/05/roses", 0), ("https://docs.tools.example.net/en/guide/install.html", 0),
    ("http://university.example.org/fr/departments/history", 0), ("https://museum.example.com/es/visit/hours", 0),
    ("https://recipes.kitchen.example.org/de/brot/4411", 0), ("http://m.weather.example.com/en/forecast/77", 0),
    ("https://forum.cyclists.example.org/en/thread/90211", 0), ("https://www.health.example.com/en/articles/sleep", 0),
    ("https://science.journal.example.org/en/vol3/paper12", 0), ("http://www.school.example.net/es/lessons/9", 0),
    ("https://travel.notes.example.com/fr/alpes/312", 0), ("https://encyclopedia.example.org/de/artikel/3321", 0),
    ("https://www.orchestra.example.com/en/programme/2020", 0), ("http://archive.example.org/en/letters/1881/22", 0),
    ("https://river.example.com/en/5512", 0), ("http://m.market.example.com/fr/101.html", 0), ("https://blog.north.example.com/es/77031/", 0),
    ("http://paper.example.net/de/6120", 0), ("https://www.harbour.example.net/en/31/", 0), ("http://stone.example.com/de/248.html", 0),
    ("https://m.meadow.example.org/es/9906", 0), ("http://teacher.example.com/en/18820", 0), ("https://bridge.example.net/fr/450.html", 0),
    ("http://www.window.example.com/en/3", 0), ("https://blog.summer.example.net/de/70215/", 0), ("http://garden.example.com/fr/6/", 0),
    ("https://casino-bonus.win777.example.com/play/free-spins", 1), ("http://cheap-pills.example.net/buy/now?aff=12", 1),
    ("https://free-download-crack.example.com/keygen/serial.exe", 1), ("http://xxx-tube.example.net/adult/video/hot", 1),
    ("https://click.ads.track.example.com/redirect/banner", 1), ("http://loan-fast-cash.example.net/apply/payday", 1),
    ("https://bet-slots.example.com/casino/jackpot", 1), ("http://replica-watches.sale.example.net/buy/cheap", 1),
    ("https://warez.example.com/download/torrent/crack.zip", 1), ("http://win-prize-now.example.net/claim/free-gift", 1),
    ("https://adult-cams.example.com/live/xxx", 1), ("http://track.pixel.example.net/ads/click/spam", 1),
    ("https://viagra-online.example.com/pills/order", 1), ("http://poker777.example.net/bonus/slots/free", 1),
    ("https://crack-serial.example.com/keygen/free-download", 1), ("http://spam-links.example.net/redirect/affiliate", 1),
)


def host_of(url: Column) -> Column:
    """What lies between the first ``://`` and the next ``/``, ``?`` or ``#``, A to Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=DEFAULT_RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    for verdict, rule_host, rule_path in reversed(ranked):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: str | None) -> str:
    """Host and path, marked, as the n-grams see them."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return f"\x01{m[1].translate(LOWER)}\x02{m[2]}\x03" if m else "\x01\x02\x03"


def features(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The URL's place and the bucket of each n-gram of each URL."""
    marked = [split_url(u) for u in urls]
    codes = code_points("".join(marked))
    ends = np.cumsum([len(m) for m in marked])
    rows, found = [], []
    for n in ORDERS:
        bucket = ngram_buckets(codes, n, BITS)
        at = np.arange(len(bucket))
        row = np.searchsorted(ends, at, side="right")
        inside = at + n <= ends[row] if len(at) else np.zeros(0, dtype=bool)
        rows.append(row[inside])
        found.append(bucket[inside])
    return np.concatenate(rows), np.concatenate(found)


def train(examples, *, rounds: int = 300, rate: float = 2.0, l2: float = 1e-3) -> UrlModel:
    """Gradient descent on the logistic loss; a URL's n-grams share a weight of 1."""
    examples = [(url, label) for url, label in examples if label is not None]
    weights, bias = np.zeros(1 << BITS), 0.0
    if not examples:
        return UrlModel(weights, -1.0)
    row, found = features([url for url, _ in examples])
    used, place = np.unique(found, return_inverse=True)
    x = np.zeros((len(examples), len(used)))
    np.add.at(x, (row, place), 1.0)
    x /= np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))
    y = np.array([float(label) for _, label in examples])
    w = np.zeros(len(used))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + bias)))
        w -= rate * (x.T @ (p - y) / len(y) + l2 * w)
        bias -= rate * float((p - y).mean())
    weights[used] = w
    return UrlModel(weights, bias)


class Judge:
    def __init__(self, model: UrlModel):
        self.model = model

    def __call__(self, urls: list[str | None]) -> tuple[np.ndarray, list[str]]:
        scores = np.empty(len(urls))
        for lo, hi in blocks(urls):
            row, found = features(urls[lo:hi])
            sums = np.bincount(row, self.model.weights[found], minlength=hi - lo)
            logit = sums / np.sqrt(np.maximum(1, np.bincount(row, minlength=hi - lo))) + self.model.bias
            scores[lo:hi] = 1 / (1 + np.exp(-logit))
        return scores, ["block" if s >= 0.5 else "allow" for s in scores]


def filter_urls(df: DataFrame, *, url_col: str = "url", rules=DEFAULT_RULES, labelled=LABELLED_URLS) -> DataFrame:
    """Adds host, path, rule, score (of the model) and verdict (the rule's, else the model's)."""
    shared = df.sparkSession.sparkContext.broadcast(train(labelled))  # 2**BITS numbers
    taken = list(df.columns)
    host, path, rule, verdict = (free_name(n, taken) for n in ("host", "path", "rule", "verdict"))
    judged = append_columns(df, [("score", "double"), ("__judged", "string")], url_col, lambda: Judge(shared.value))
    score = judged.columns[-2]
    split = judged.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    found = split.withColumn("__rule", matching_rule(F.col(host), F.col(path), rules))
    out = found.withColumns({rule: F.col("__rule.rule"), verdict: F.coalesce(F.col("__rule.verdict"), F.col("__judged"))})
    return out.select(*df.columns, host, path, rule, score, verdict)
