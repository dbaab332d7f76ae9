"""URL filter: rules on host and path, else a logistic regression.

The model reads hashed character n-grams of host and path. Everything is Spark's
own expressions: features are arrays of slots, the weights are one array literal,
a score is an aggregate over the array, and a training step is one grouped sum
over a small labelled table. The labelled table is at most ``PER_VERDICT``
different urls for each verdict; any table with ``url`` and ``verdict`` will do.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isoloir.llm.common import bounded_sample, free_name, stored

#: Rules (host and path) and their verdicts.
RULES = {
    "net/": "block",
    "example.net/en/": "allow",
    "example.com/de/": "block",
    "org/fr/": "allow",
}
#: Labelled urls of each verdict that the model is trained on, at most.
PER_VERDICT = 1000
SLOTS = 4096
GRAMS = (2, 3, 4)
#: Steps of gradient descent, each with so much of the one before.
STEPS = 24
RATE = 4.0
MOMENTUM = 0.9
DECAY = 1e-4
#: A url without a rule is blocked from this probability on.
BLOCK_FROM = 0.5

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: str) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, 1)
    return F.translate(host, _UPPER, _UPPER.lower())


def path_of(url: str) -> Column:
    """What follows the host up to ``? #``; empty where there is none."""
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, 2)


def rule_of(host: str, path: str, rules: dict[str, str]) -> Column:
    """The longest rule that fits, or null.

    A rule's host fits itself and its subdomains; its path must begin the path.
    """
    found = [F.lit(None).cast("string")]
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, _, rest = rule.partition("/")
        fits = (F.col(host) == name) | F.col(host).endswith(f".{name}")
        found.insert(-1, F.when(fits & F.col(path).startswith(f"/{rest}"), F.lit(rule)))
    return F.coalesce(*found)


def _grams(chars: str, kind: str) -> list[Column]:
    """Slots of the n-grams of an array of characters."""
    none = F.array().cast("array<int>")
    out = []
    for n in GRAMS:
        slots = F.transform(F.sequence(F.lit(1), F.size(chars) - (n - 1)), _slot_at(chars, kind, n))
        out.append(F.when(F.size(chars) >= n, slots).otherwise(none))
    return out


def _slot_at(chars: str, kind: str, n: int) -> Callable[[Column], Column]:
    def slot(start: Column) -> Column:
        gram = F.concat(*[F.element_at(chars, start + F.lit(k)) for k in range(n)])
        return F.pmod(F.xxhash64(F.lit(f"{kind}{n}"), gram), F.lit(SLOTS)).cast("int")

    return slot


def with_slots(urls: DataFrame, host: str, path: str, into: str) -> DataFrame:
    """The slots of the character n-grams of host and path, each between end marks.

    The characters are split into a column of their own first, so that a long url
    takes time in proportion to its length.
    """
    chars = {c: free_name(urls, f"{c}_chars") for c in (host, path)}
    split = {to: F.split(F.concat(F.lit("\x02"), c, F.lit("\x03")), "") for c, to in chars.items()}
    grams = _grams(chars[host], "h") + _grams(chars[path], "p")
    return urls.withColumns(split).withColumn(into, F.concat(*grams)).drop(*chars.values())


@dataclass
class UrlModel:
    """Weights by slot; without labelled rows every url scores one half."""

    weights: list[float] = field(default_factory=lambda: [0.0] * SLOTS)
    bias: float = 0.0

    def score(self, slots: str) -> Column:
        """The probability of a block, from a column of slots."""
        weights = F.from_json(F.lit(json.dumps(self.weights)), "array<double>")
        total = F.aggregate(slots, F.lit(0.0), lambda s, i: s + F.get(weights, i))
        return 1 / (1 + F.exp(-(total / F.sqrt(F.size(slots)) + F.lit(self.bias))))


def labelled_urls(pages: DataFrame, rules: dict[str, str], url: str = "url") -> DataFrame:
    """Different urls that a rule decides, with its verdict: ``PER_VERDICT`` of each at most.

    A null url, or one without ``://``, is decided by no rule. Repeated urls are one row;
    an empty table gives an empty result; other columns are ignored.
    """
    parts = pages.select(F.col(url).alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    ruled = parts.withColumn("verdict", _verdict_of(rule_of("host", "path", rules), rules))
    distinct = ruled.where("verdict is not null").select("url", "verdict").distinct()
    picks = [
        bounded_sample(distinct.where(F.col("verdict") == v), "url", PER_VERDICT)
        for v in ("allow", "block")
    ]
    return picks[0].unionByName(picks[1])


def _verdict_of(rule: Column, rules: dict[str, str]) -> Column:
    verdict = F.lit(None).cast("string")
    for name, what in rules.items():
        verdict = F.when(rule == name, F.lit(what)).otherwise(verdict)
    return verdict


def train(labelled: DataFrame) -> UrlModel:
    """A model of ``url`` and ``verdict`` rows; each step is a grouped sum of at most ``SLOTS`` rows.

    Rows that repeat count each; a null url counts as one with empty parts, a null verdict as
    none. The table must be bounded, as that of ``labelled_urls`` is. Without rows every url
    scores one half. Other columns are ignored.
    """
    labelled = labelled.where("verdict IS NOT NULL")
    parts = labelled.select(host_of("url").alias("host"), path_of("url").alias("path"), "verdict")
    label = (F.col("verdict") == "block").cast("double").alias("label")
    # At most 2 * PER_VERDICT rows.
    rows = stored(with_slots(parts, "host", "path", "slots").select("slots", label).coalesce(1), "urls")
    total = rows.count()
    model, speed = UrlModel(), [0.0] * (SLOTS + 1)
    for _ in range(STEPS if total else 0):
        error = rows.select("slots", (model.score("slots") - F.col("label")).alias("error"))
        # Slot -1 stands for the bias.
        spread = error.select(
            F.explode(F.concat(F.col("slots"), F.array(F.lit(-1)))).alias("slot"),
            "error",
            F.sqrt(F.size("slots")).alias("norm"),
        )
        change = F.when(F.col("slot") < 0, F.col("error")).otherwise(F.col("error") / F.col("norm"))
        speed = [MOMENTUM * s for s in speed]
        for slot, value in spread.groupBy("slot").agg(F.sum(change)).collect():
            speed[slot] -= RATE * value / total
        model.weights = [round(w * (1 - DECAY) + s, 9) for w, s in zip(model.weights, speed, strict=False)]
        model.bias += speed[-1]
    return model


def judge(
    pages: DataFrame, model: UrlModel, rules: dict[str, str] | None = None, url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    A null url or one without ``://`` has an empty host and path, no rule, and the
    model's verdict on empty parts. Columns of ``pages`` that bear one of these names are
    replaced. Rows are judged one by one, so repeated rows and an empty table need no care.
    """
    rules = RULES if rules is None else rules
    source = free_name(pages, "source_url")
    judged = pages.withColumn(source, F.col(url))
    judged = judged.withColumns({"host": host_of(source), "path": path_of(source)})
    judged = judged.withColumn("rule", rule_of("host", "path", rules))
    slots = free_name(judged, "slots")
    judged = with_slots(judged, "host", "path", slots).withColumn("score", model.score(slots))
    modelled = F.when(F.col("score") >= BLOCK_FROM, "block").otherwise("allow")
    verdict = F.coalesce(_verdict_of(F.col("rule"), rules), modelled)
    return judged.withColumn("verdict", verdict).drop(source, slots)
