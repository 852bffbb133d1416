"""URL filter: gradient-boosted trees on lexical features, trained from labelled URLs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common as C

#: Most labelled URLs that one model is fitted on, chosen by hash.
FIT_URLS = 20_000
TREES, DEPTH, RATE, BINS, LEAF, L2 = 40, 4, 0.3, 32, 5, 1.0
REJECT = 0.5
#: Words that, as a whole part of a host's name, put it on the block list by which the query labels its URLs.
BLOCKED = tuple("adult ads bets betting casino crack escort gambling keygen loans lottery malware phishing pills poker porn slots spam tracker viagra warez xxx".split())
#: Suffixes of two labels under which names are registered; elsewhere the last label is the suffix.
SUFFIXES = tuple(
    "ac.jp ac.uk blogspot.com co.id co.il co.in co.jp co.ke co.kr co.nz co.th co.uk co.za com.ar com.au com.br com.cn com.co com.eg com.hk com.mx com.my com.ng com.pe com.ph com.pk com.pl com.sg com.tr com.tw com.ua com.ve com.vn "
    "edu.au edu.cn github.io gob.mx gov.au gov.br gov.cn gov.in gov.uk ltd.uk me.uk ne.jp net.au net.br net.cn net.nz net.uk or.jp or.kr org.au org.br org.cn org.in org.nz org.uk org.za plc.uk sch.uk".split()
)
#: First labels that say nothing of whose host it is.
FRONTS = ("www", "m", "blog", "mobile", "amp", "en", "de", "fr", "es")
FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio", "entropy", "host_entropy", "params", "query_length", "hyphens",
    "host_hyphens", "https", "fragment", "longest_label", "vowel_ratio", "suffix_share", "suffix_rate", "extension",
)


def entropy(s: str) -> float:
    """Bits a character of the distribution of the characters of s."""
    if not s:
        return 0.0
    n = np.unique(np.frombuffer(s.encode("utf-32-le", "replace"), np.uint32), return_counts=True)[1] / len(s)
    return float(-(n * np.log2(n)).sum())


def split_url(url: str) -> tuple[str, str, str, str, str]:
    """(scheme, host, path, query, fragment), in lower case but for path and later; what has no "://" is host first."""
    scheme, sep, rest = url.strip().partition("://")
    if not sep:
        scheme, rest = "", url.strip()
    rest, _, fragment = rest.partition("#")
    rest, _, query = rest.partition("?")
    host, slash, path = rest.partition("/")
    return scheme.lower(), host.rpartition("@")[2].partition(":")[0].lower(), slash + path, query, fragment


def suffix(url: str) -> str:
    """The public suffix of the host by SUFFIXES, or "ip"."""
    host = split_url(url)[1]
    if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", host):
        return "ip"
    two = ".".join(host.split(".")[-2:])
    return two if two in SUFFIXES else host.split(".")[-1]


def lexical(url: str, share: float, rate: float) -> list[float]:
    """FEATURES of a URL; share and rate are its suffix's."""
    scheme, host, path, query, fragment = split_url(url)
    labels = [x for x in host.split(".") if x]
    digits = lambda s: sum(map(str.isdigit, s)) / max(1, len(s))
    last = path.rpartition("/")[2]
    return [
        len(url), len(host), len(path), sum(1 for x in path.split("/") if x), len(labels), digits(url), digits(host), entropy(url), entropy(host),
        sum(1 for x in query.split("&") if x), len(query), url.count("-"), host.count("-"), float(scheme == "https"), float(bool(fragment)), max(map(len, labels), default=0),
        sum(c in "aeiouy" for c in host) / max(1, len(host)), share, rate, float("." in last),
    ]


class Trees:
    """Boosted regression trees on binned features by the second-order logistic loss; a node splits where the gain is largest."""

    def __init__(self, edges: list[np.ndarray], base: float, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.edges, self.base, self.trees = edges, base, trees

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i]) for i, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = np.where(feature[at] < 0, at, 2 * at + 1 + (b[rows, feature[at]] > cut[at]))
            out += value[at]
        return out

    def chances(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Trees for rows x(n, features) with labels y in 0..1; without both labels, the base rate alone."""
    n = len(x)
    edges = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, BINS + 1)[1:-1])) if n else np.zeros(0) for i in range(x.shape[1])]
    rate = (y.sum() + 0.5) / (n + 1)
    model = Trees(edges, float(np.log(rate / (1 - rate))), [])
    if not n or y.min() == y.max():
        return model
    b, raw, size = model.bins(x), np.full(n, model.base), 2 ** (DEPTH + 1) - 1
    wide = b + np.arange(x.shape[1]) * BINS
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        g, h = p - y, p * (1 - p)
        feature, cut, value, at = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size), np.zeros(n, np.int64)
        for node in range(size):
            own = np.flatnonzero(at == node)
            if not len(own):
                continue
            gs, hs = g[own].sum(), h[own].sum()
            value[node] = -RATE * gs / (hs + L2)
            if node >= 2**DEPTH - 1 or len(own) < 2 * LEAF:
                continue
            flat = wide[own].ravel()
            k = x.shape[1]
            cum = lambda w: np.bincount(flat, weights=np.repeat(w, k), minlength=k * BINS).reshape(k, BINS).cumsum(axis=1)  # noqa: B023, E731
            gl, hl, nl = cum(g[own]), cum(h[own]), cum(np.ones(len(own)))
            gain = gl**2 / (hl + L2) + (gs - gl) ** 2 / (hs - hl + L2) - gs**2 / (hs + L2)
            gain[(nl < LEAF) | (len(own) - nl < LEAF)] = 0
            f, c = divmod(int(gain.argmax()), BINS)
            if gain[f, c] > 1e-6:
                feature[node], cut[node] = f, c
                at[own] = 2 * node + 1 + (b[own, f] > c)
        model.trees.append((feature, cut, value))
        raw += value[at]
    return model


def _host(url: Column) -> Column:
    return F.regexp_extract(F.lower(F.trim(url)), r"^(?:[^:/?#]+://)?(?:[^/?#]*@)?([^/?#:]*)", 1)


def blocked(url: Column, words: tuple[str, ...] = BLOCKED) -> Column:
    """1 where a part of a URL's host between dots and hyphens is one of these words, else 0; null for null."""
    return F.when(url.isNotNull(), _host(url).rlike(r"(?:^|[.-])(?:" + "|".join(map(re.escape, words)) + r")(?:[.-]|$)").cast("int"))


def placed(urls: DataFrame) -> DataFrame:
    """urls(url) with suffix, as :func:`suffix` has it, and fold: 0 or 1 by the host without a front label, so that a host's URLs are in one fold."""
    host = _host(F.col("url"))
    two = F.substring_index(host, ".", -2)
    tail = F.when(host.rlike(r"^[0-9]+(\.[0-9]+){3}$"), "ip").when(two.isin(*SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))
    own = F.regexp_replace(host, "^(?:" + "|".join(FRONTS) + r")\.(?=[^.]+\.)", "")
    return urls.withColumns({"suffix": F.coalesce(tail, F.lit("")), "fold": F.coalesce(F.pmod(F.xxhash64(own), F.lit(2)), F.lit(0)).cast("int")})


def filtered(pages: DataFrame, labelled: DataFrame, fit_urls: int = FIT_URLS, reject: float = REJECT) -> DataFrame:
    """page_id, url, score (chance of unwanted) and keep (below ``reject``) of every row of pages(page_id, url).

    labelled(url, label) trains the trees; of differing labels of one URL the larger counts. Hosts fall into two folds, and
    a URL is scored by the model and the suffix statistics of the other fold, so that nothing is scored by labels of its
    own host: each model is fitted on at most ``fit_urls`` labelled URLs, by hash. suffix_share is the share of all pages
    that have the URL's public suffix, suffix_rate the smoothed rate of label 1 over all labelled URLs of that suffix and
    fold. Null and blank URLs have score null and keep false; repeated rows give repeated rows; without labels of both
    kinds in a fold the other has its base rate for a score; an empty table gives no rows; other columns are ignored.
    """
    import pyarrow as pa

    spark, key = pages.sparkSession, C.kind(pages, "page_id")
    pages = placed(C.columns(pages, "page_id", "url").withColumn("url", F.col("url").cast("string")))
    labelled = C.columns(labelled, "url", "label").withColumn("url", F.col("url").cast("string"))
    known = C.cut(placed(labelled.where("label is not null and trim(url) <> ''").groupBy("url").agg(F.max("label").cast("int").alias("label"))))
    summed = lambda what, f: F.coalesce(F.sum(F.when(F.col("fold") == f, what)), F.lit(0))
    rates = known.groupBy("suffix").agg(*(summed(what, f).alias(f"{name}{f}") for f in (0, 1) for name, what in (("bad", F.col("label")), ("n", F.lit(1)))))
    counts = pages.where("trim(url) <> ''").groupBy("suffix").agg(F.count("*").alias("pages"))
    numbers = ["pages", "bad0", "bad1", "n0", "n1"]
    stats = C.cut(counts.join(rates, "suffix", "full").na.fill(0, numbers))
    total = stats.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers)).first()
    all_pages, base = max(1, total.pages), [(total[f"bad{f}"] + 0.5) / (total[f"n{f}"] + 1) for f in (0, 1)]
    stats = C.small_ids(stats)

    def rows(urls, share, bad, n, fold, own=None) -> np.ndarray:
        """Features by the statistics of ``fold``, without the URL's own label where it is one of them."""
        own = [None] * len(urls) if own is None else own
        rate = [(b - (y or 0) + 20 * base[f]) / (m - (y is not None) + 20) for b, m, f, y in zip(bad, n, fold, own, strict=True)]
        return np.array([lexical(u or "", p / all_pages, r) for u, p, r in zip(urls, share, rate, strict=True)]).reshape(-1, len(FEATURES))

    models = []
    for f in (0, 1):
        sample = known.where(F.col("fold") == 1 - f).orderBy(F.xxhash64("url"), "url").limit(fit_urls).join(stats, "suffix", "left").na.fill(0, numbers).toPandas().sort_values("url")
        models.append(fit(rows(sample["url"], sample["pages"], sample[f"bad{1 - f}"], sample[f"n{1 - f}"], [1 - f] * len(sample), sample["label"]), sample["label"].to_numpy(float)))
    shared = spark.sparkContext.broadcast(models)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            urls, share, bad, n, fold = (b.column(i).to_pylist() for i in range(1, 6))
            x, at = rows(urls, share, bad, n, [1 - f for f in fold]), np.array(fold, np.int64)
            s = np.zeros(len(urls))
            for f in (0, 1):
                s[at == f] = shared.value[f].chances(x[at == f])
            none = np.array([not (u or "").strip() for u in urls], bool)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s, mask=none), pa.array((s < reject) & ~none)], ["page_id", "url", "score", "keep"])

    other = lambda name: F.when(F.col("fold") == 0, F.col(f"{name}1")).otherwise(F.col(f"{name}0")).alias(name)
    joined = pages.join(stats, "suffix", "left").na.fill(0, numbers)
    return joined.select("page_id", "url", "pages", other("bad"), other("n"), "fold").mapInArrow(score, f"page_id {key}, url string, score double, keep boolean")
