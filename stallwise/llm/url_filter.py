"""URL filter: host and path rules first, a character n-gram model for the rest.

A rule fits its host and all its subdomains if the path of the URL starts with
the path of the rule; the rule with the longest text wins. URLs that no rule
fits go to a logistic regression on hashed character n-grams of host and path,
trained on a small labelled table of URLs.

Only URLs without a rule are sent to Python, where the n-grams of a whole batch
are hashed as arrays.

Defined cases: a null URL or one without `://` has an empty host and path and is
judged by the model like any other; every input row gives one, also those that
repeat an id or have none; an empty table gives no rows; extra columns are
ignored. Very long URLs are read whole.
"""

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stallwise.llm import common

#: (verdict, host, path) as published.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Fixed values, invented: parts of the labelled URLs. Each host is labelled with each path of its kind.
UNWANTED = {
    "hosts": [
        "cheap-pills.example.net",
        "win.casino7.example",
        "xxx.adult-cams.example",
        "ads.tracker9.example",
        "free-money.lotto.example",
        "hot-singles.dating.example",
        "replica-watches.shop.example",
        "crack-serial.warez.example",
    ],
    "paths": [
        "/buy/now?id=1",
        "/bonus/1",
        "/click/offer",
        "/promo/spin-win",
        "/login/verify-account",
        "/track?utm_source=spam",
        "/download/keygen.exe",
        "/xxx/free-cams",
    ],
}
WANTED = {
    "hosts": [
        "www.city-library.example.net",
        "news.daily.example.com",
        "docs.project.example.org",
        "blog.garden.example.net",
        "university.example.edu",
        "m.museum.example.com",
        "forum.cycling.example.net",
        "weather.region.example",
    ],
    "paths": [
        "/en/12034",
        "/fr/recette/341.html",
        "/de/artikel/992",
        "/es/noticias/77",
        "/article/history-of-tea",
        "/docs/install.html",
        "/2021/05/a-day-at-the-lake",
        "/questions/5512/how-to",
    ],
}
#: (label, host and path): 1 is unwanted.
LABELLED = [(label, host + path) for label, kind in ((1, UNWANTED), (0, WANTED)) for host in kind["hosts"] for path in kind["paths"]]
BITS, ORDERS = 16, (2, 3, 4)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return common.lower_az(F.coalesce(rest, F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The position of the longest rule that fits, in the list sorted longest first; null if none does."""
    found = None
    for i, (_, rule_host, rule_path) in enumerate(by_length(rules)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, i) if found is None else found.when(fits, i)
    return F.lit(None).cast("int") if found is None else found


def by_length(rules: Sequence[tuple[str, str, str]]) -> list[tuple[str, str, str]]:
    return sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))


def features(texts: Sequence[str], bits: int = BITS, orders: Sequence[int] = ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of the distinct hashed character n-grams of some texts; their ends are marked."""
    raws = [f"^{text}$".encode() for text in texts]
    data = np.frombuffer(b"".join(raws), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(raws)), [len(raw) for raw in raws])
    found = []
    for n in orders:
        if len(data) < n:
            continue
        packed = np.full(len(data) - n + 1, n, np.uint64)
        for k in range(n):
            packed = packed << np.uint64(8) | data[k : len(data) - n + 1 + k]
        inside = owner[: len(packed)] == owner[n - 1 :]
        place = common.mix(packed[inside]) & np.uint64((1 << bits) - 1)
        found.append(owner[: len(packed)][inside].astype(np.uint64) << np.uint64(bits) | place)
    distinct = np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    return (distinct >> np.uint64(bits)).astype(np.int64), (distinct & np.uint64((1 << bits) - 1)).astype(np.int64)


def train(labelled: Sequence[tuple[int, str]] = LABELLED, bits: int = BITS, epochs: int = 40, rate: float = 0.5, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias by gradient steps over the labelled URLs, one of each kind in turn."""
    weights, bias = np.zeros(1 << bits), 0.0
    sides = [[text for label, text in labelled if label == y] for y in (1, 0)]
    most = max(map(len, sides))
    turns = [(1 - y, side[i * len(side) // most]) for i in range(most) for y, side in enumerate(sides) if side]
    rows = [(label, features([text], bits)[1]) for label, text in turns]
    for _ in range(epochs):
        for label, at in rows:
            scale = 1 / np.sqrt(max(1, len(at)))
            error = label - 1 / (1 + np.exp(-(weights[at].sum() * scale + bias)))
            weights[at] += rate * error * scale - rate * decay * weights[at]
            bias += 0.1 * rate * error
    return weights.astype(np.float32), float(bias)


def scored(weights: np.ndarray, bias: float, texts: Sequence[str], bits: int = BITS) -> np.ndarray:
    """The score of each text: 0 to 1, higher is likelier unwanted."""
    owner, place = features(texts, bits)
    sums = np.bincount(owner, weights[place], len(texts))
    many = np.bincount(owner, minlength=len(texts))
    return 1 / (1 + np.exp(-(sums / np.sqrt(np.maximum(many, 1)) + bias)))


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, labelled=LABELLED, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict, score (null where a rule decides)."""
    weights, bias = train(labelled)  # 256 KB whatever the input, sent with the task
    url = common.column(url_col).cast("string")
    rows = pages.select(common.column(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = rows.withColumn("rule_at", rule_of(F.col("host"), F.col("path"), rules))
    ordered = by_length(rules)
    kind = dict(rows.dtypes)["page_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = [h + p for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())]
                columns = [*batch.columns, pa.array(scored(weights, bias, texts), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "host", "path", "score"])

    def of_rule(part) -> Column:
        named = [F.when(F.col("rule_at") == i, F.lit(part(rule))) for i, rule in enumerate(ordered)]
        return F.coalesce(*named, F.lit(None).cast("string"))

    ruled = rows.filter("rule_at IS NOT NULL").select(
        "page_id", "host", "path", of_rule(lambda r: r[1] + r[2]).alias("rule"), of_rule(lambda r: r[0]).alias("verdict"), F.lit(None).cast("double").alias("score")
    )
    others = rows.filter("rule_at IS NULL").drop("rule_at").mapInArrow(run, f"page_id {kind}, host string, path string, score double")
    verdict = F.when(F.col("score") >= 0.5, "block").otherwise("allow").alias("verdict")
    return ruled.unionByName(others.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict, "score"))
