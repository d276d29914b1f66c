"""KPI rules over ordered text nodes, as column expressions: no Python in the data path.

A rule set is data: description, unit, value and anywhere rules. A description
rule scores the nodes that it matches, nearest first, with decays for distance,
repeated hits and superfluous letters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geometry import weighted_distance
from ..functions.text import lower_letters
from ..schemas import EUCLID, MAY_INCLUDE, MUST_EXCLUDE, MUST_INCLUDE, MUST_INCLUDE_EACH, WEIGHTED_UP_ONLY
from .filters import value_matches
from .joins import by_keys


@dataclass(frozen=True)
class DescriptionRule:
    """A pattern that matches from a node's start; lower-cased nodes unless case counts. half_life 0: no letter decay."""

    pattern: str
    score: float
    mode: int = MAY_INCLUDE
    decay: float = 1.0
    hit_decay: float = 1.0
    half_life: float = 0.0
    free_letters: int = 0
    case: bool = False
    counts: bool = True
    joined: bool = False

    @property
    def letter_decay(self) -> float:
        return 0.5 ** (1.0 / self.half_life) if self.half_life > 0 else 1.0

    def hits(self, text: Column) -> Column:
        return F.rlike(text if self.case else F.lower(text), F.lit(f"(?d)^(?:{self.pattern})"))

    def worth(self, text: Column) -> Column:
        """The score of a matching text for its superfluous letters alone."""
        return self.score * F.pow(F.lit(self.letter_decay), F.greatest(F.length(lower_letters(text)) - self.free_letters, F.lit(0)).cast("double"))

    def match(self, nodes: Column) -> Column:
        """struct(ok, score) for an array of texts."""
        start = F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("i"), F.lit(0).alias("hits"))

        def step(acc: Column, text: Column) -> Column:
            hit = self.hits(text)
            more = self.worth(text) * F.pow(F.lit(self.decay), acc["i"].cast("double")) * F.pow(F.lit(self.hit_decay), acc["hits"].cast("double"))
            return F.struct((acc["score"] + F.when(hit, more).otherwise(0.0)).alias("score"), (acc["i"] + 1).alias("i"), (acc["hits"] + hit.cast("int")).alias("hits"))

        whole = F.array_join(nodes, " ")
        as_one = self.hits(whole) if self.joined else F.lit(False)
        one_worth = F.when(as_one, self.worth(whole)).otherwise(0.0) if self.joined else F.lit(0.0)

        def verdict(acc: Column) -> Column:
            if self.mode == MUST_EXCLUDE:
                failed, lost = acc["hits"] > 0, -1.0
            elif self.mode == MUST_INCLUDE:
                failed, lost = (acc["hits"] == 0) & ~as_one, 0.0
            elif self.mode == MUST_INCLUDE_EACH:
                failed, lost = (acc["hits"] < acc["i"]) & ~as_one, 0.0
            else:
                failed, lost = F.lit(False), 0.0
            return F.struct((~failed).alias("ok"), F.when(failed, lost).otherwise(F.greatest(one_worth, acc["score"])).alias("score"))

        return F.aggregate(nodes, start, step, verdict)

    def match_text(self, text: Column) -> Column:
        """match() of one text alone, which is looked at once."""
        told = lambda ok, score: F.struct(F.lit(ok).alias("ok"), score.alias("score"))
        missed = told(self.mode not in (MUST_INCLUDE, MUST_INCLUDE_EACH), F.lit(0.0))
        worth = self.worth(text) if self.joined else F.greatest(F.lit(0.0), self.worth(text))
        return F.when(self.hits(text), told(False, F.lit(-1.0)) if self.mode == MUST_EXCLUDE else told(True, worth)).otherwise(missed)


@dataclass(frozen=True)
class AnywhereRule:
    """A pattern, in any case, for texts near a value on its page."""

    pattern: str
    score: float
    mode: int = MAY_INCLUDE
    distance: int = EUCLID
    decay: float = 1.0
    hit_decay: float = 1.0
    half_life: float = 0.0
    free_letters: int = 0


@dataclass(frozen=True)
class KpiRule:
    """All rules of a KPI and the scores that it asks for."""

    kpi_id: float
    name: str
    descriptions: tuple[DescriptionRule, ...]
    units: tuple[str, ...] = ()
    values: tuple[str, ...] = ()
    anywhere: tuple[AnywhereRule, ...] = ()
    numeric: bool = True
    percentage: bool | None = None
    year: bool = False
    minimum_score: float = 500.0
    minimum_description: float = 250.0
    extra: dict = field(default_factory=dict, compare=False)

    def describe(self, nodes: Column) -> Column:
        """struct(ok, score): the sum of the description rules; not ok if one fails, none counts, or the sum is too small."""
        return self._summed([r.match(nodes) for r in self.descriptions])

    def describe_text(self, text: Column) -> Column:
        """describe() of one text alone."""
        return self._summed([r.match_text(text) for r in self.descriptions])

    def _summed(self, matches: list[Column]) -> Column:
        counted = [r.mode in (MAY_INCLUDE, MUST_INCLUDE, MUST_INCLUDE_EACH) and r.counts for r in self.descriptions]
        found = F.array(*[F.struct(m.alias("m"), F.lit(c).alias("counts")) for m, c in zip(matches, counted)])
        start = F.struct(F.lit(False).alias("bad"), F.lit(0.0).alias("least"), F.lit(False).alias("some"), F.lit(0.0).alias("total"))

        def add(acc: Column, f: Column) -> Column:
            ok, score = f["m"]["ok"], f["m"]["score"]
            return F.struct(
                (acc["bad"] | ~ok).alias("bad"), F.when(ok, acc["least"]).otherwise(F.least(acc["least"], score)).alias("least"),
                (acc["some"] | (f["counts"] & ok & (score > 0))).alias("some"), (acc["total"] + score).alias("total"),
            )

        def verdict(acc: Column) -> Column:
            ok = ~acc["bad"] & acc["some"] & (acc["total"] >= self.minimum_description) & (acc["total"] > 0)
            return F.struct(ok.alias("ok"), F.when(acc["bad"], acc["least"]).when(~acc["some"], 0.0).otherwise(acc["total"]).alias("score"))

        return F.aggregate(found, start, add, verdict)

    def unit_ok(self, unit: Column) -> Column:
        ok = F.lit(True)
        for p in self.units:
            ok = ok & F.rlike(unit, F.lit(f"(?id)^(?:{p})"))
        return ok

    def value_ok(self, value: Column) -> Column:
        return value_matches(value, self.numeric, self.percentage, self.year, self.values)


def describe_nodes(nodes: DataFrame, rules: list[KpiRule], column: str = "nodes") -> DataFrame:
    """nodes with a row for each rule that its texts satisfy, an array or one text: kpi_id, kpi_name, desc_score."""
    text = F.col(column)
    if nodes.schema[column].dataType.simpleString() == "string":
        told = lambda r: r.describe_text(text)
    else:  # a list of one is looked at as a text
        told = lambda r: F.when(F.size(text) == 1, r.describe_text(F.get(text, F.lit(0)))).otherwise(r.describe(text))
    found = F.array(*[F.struct(F.lit(r.kpi_id).alias("kpi_id"), F.lit(r.name).alias("kpi_name"), told(r).alias("m")) for r in rules])
    rows = nodes.select("*", F.explode(found).alias("r")).where("r.m.ok")
    return rows.select(*nodes.columns, "r.kpi_id", "r.kpi_name", F.col("r.m.score").alias("desc_score"))


def describe_lists(lists: DataFrame, rules: list[KpiRule], key: str = "list_id", column: str = "nodes") -> DataFrame:
    """(key, kpi_id, kpi_name, ok, score): what KpiRule.describe() says of each list of texts, for the KPIs that hit any of them.

    lists: (key, column array<string>), unique by key. The rules are data: a text meets all patterns in one pass, and hits are
    counted and summed by list and rule, so the plan stays small however many rules there are. A KPI that hits nothing
    has no row; its score would be 0 and not ok.
    """
    many = F.size(column)
    each = lists.select(key, many.alias("_n"), F.posexplode(F.concat(F.col(column), F.array(F.array_join(column, " ")))).alias("_pos", "_txt"))  # the texts, and all as one
    listed = [(k, n, r) for k in rules for n, r in enumerate(k.descriptions)]
    met = []
    for k, n, r in listed:
        facts = {"kpi_id": float(k.kpi_id), "kpi_name": k.name, "rule": n, "mode": r.mode, "base": float(r.score), "decay": float(r.decay), "hit_decay": float(r.hit_decay), "letter": r.letter_decay, "free": r.free_letters, "counts": r.counts, "joined": r.joined}
        met.append(F.when(r.hits(F.col("_txt")), F.struct(*[F.lit(v).alias(c) for c, v in facts.items()])))
    hits = each.select(key, "_n", "_pos", "_txt", F.explode(F.array_compact(F.array(*met))).alias("r")).select(key, "_n", "_pos", "_txt", "r.*")
    hits = hits.withColumn("_whole", F.col("_pos") == F.col("_n")).where("joined or not _whole")
    spare = F.greatest(F.length(lower_letters(F.col("_txt"))) - F.col("free"), F.lit(0)).cast("double")
    before = F.row_number().over(Window.partitionBy(key, "kpi_id", "rule").orderBy("_pos")) - 1
    worth = hits.withColumns({"_worth": F.col("base") * F.pow("letter", spare), "_h": before})
    part = F.col("_worth") * F.pow("decay", F.col("_pos").cast("double")) * F.pow("hit_decay", F.col("_h").cast("double"))
    one = worth.groupBy(key, "_n", "kpi_id", "kpi_name", "rule", "mode", "counts").agg(
        F.coalesce(F.sum(F.when(~F.col("_whole"), part)), F.lit(0.0)).alias("_sum"), F.coalesce(F.max(F.when(F.col("_whole"), F.col("_worth"))), F.lit(0.0)).alias("_one"),
        F.sum((~F.col("_whole")).cast("int")).alias("_hits"), F.max(F.col("_whole")).alias("_as_one"),
    )
    mode, score = F.col("mode"), F.greatest("_one", "_sum")
    held = F.when(mode == MUST_EXCLUDE, F.col("_hits") == 0).when(mode == MUST_INCLUDE_EACH, (F.col("_hits") == F.col("_n")) | F.col("_as_one")).otherwise(F.lit(True))
    by = one.groupBy(key, "_n", "kpi_id", "kpi_name").agg(
        F.max((mode == MUST_EXCLUDE) & (F.col("_hits") > 0)).alias("_excluded"), F.sum(((mode == MUST_INCLUDE) & held).cast("int")).alias("_musts"), F.sum(((mode == MUST_INCLUDE_EACH) & held).cast("int")).alias("_each"),
        F.max(held & F.col("counts") & mode.isin(MAY_INCLUDE, MUST_INCLUDE, MUST_INCLUDE_EACH) & (score > 0)).alias("_some"), F.sum(F.when(held, score).otherwise(0.0)).alias("_total"),
    )
    need = F.coalesce(*[
        F.when(F.col("kpi_id") == float(k.kpi_id), F.struct(*[F.lit(sum(r.mode == m for r in k.descriptions)).alias(c) for m, c in ((MUST_INCLUDE, "m"), (MUST_INCLUDE_EACH, "e"))], F.lit(float(k.minimum_description)).alias("least")))
        for k in rules
    ])
    judged = by.withColumn("_need", need).withColumn("_bad", F.col("_excluded") | (F.col("_musts") < F.col("_need.m")) | ((F.col("_n") > 0) & (F.col("_each") < F.col("_need.e"))))
    total = F.col("_total")
    ok = ~F.col("_bad") & F.col("_some") & (total >= F.col("_need.least")) & (total > 0)
    points = F.when(F.col("_bad"), F.when(F.col("_excluded"), -1.0).otherwise(0.0)).when(F.col("_some"), total).otherwise(0.0)
    return judged.select(key, "kpi_id", "kpi_name", ok.alias("ok"), points.alias("score"))


def anywhere_matches(values: DataFrame, texts: DataFrame, rules: list[KpiRule], keys: list[str]) -> DataFrame:
    """values (*keys, kpi_id, item_id, x, y, page_diag) with anywhere_ok and anywhere_score from all texts (*keys, txt, x, y) of the page.

    A KPI's rules are data: texts meet all patterns in one pass over them, values meet what their KPI's patterns found in
    one join. The best matches of a rule come first, and each further hit counts less. Values of a KPI without such rules
    are ok with score 0.
    """
    own = [*keys, "kpi_id", "item_id"]
    listed = [(k.kpi_id, n, r) for k in rules for n, r in enumerate(k.anywhere)]
    plain = values.withColumn("anywhere_ok", F.lit(True)).withColumn("anywhere_score", F.lit(0.0))
    if not listed:
        return plain
    met = [
        F.when(
            F.rlike("txt", F.lit(f"(?id)^(?:{r.pattern})")),
            F.struct(
                F.lit(float(kpi)).alias("kpi_id"), F.lit(n).alias("rule"), F.lit(r.mode).alias("mode"), F.lit(r.distance).alias("kind"), F.lit(float(r.score)).alias("base"), F.lit(float(r.decay)).alias("decay"),
                F.lit(float(r.hit_decay)).alias("hit_decay"), F.lit(0.5 ** (1.0 / r.half_life) if r.half_life > 0 else 1.0).alias("letter"), F.lit(r.free_letters).alias("free"),
            ),
        )
        for kpi, n, r in listed
    ]
    hits = texts.select(*keys, "txt", F.col("x").alias("tx"), F.col("y").alias("ty"), F.explode(F.array_compact(F.array(*met))).alias("r")).select(*keys, "txt", "tx", "ty", "r.*")
    pairs = values.select(*own, "x", "y", "page_diag").join(by_keys(hits), [*keys, "kpi_id"])
    straight = F.sqrt((F.col("tx") - F.col("x")) ** 2 + (F.col("ty") - F.col("y")) ** 2)
    weighted = lambda up: weighted_distance(F.col("x"), F.col("y"), F.col("tx"), F.col("ty"), F.col("page_diag") * 0.0007, up)
    dist = F.when(F.col("kind") == EUCLID, straight).when(F.col("kind") == WEIGHTED_UP_ONLY, weighted(True)).otherwise(weighted(False))
    spare = F.greatest(F.length(lower_letters(F.col("txt"))) - F.col("free"), F.lit(0)).cast("double")
    scored = pairs.withColumn("d", dist).where("d <> -1").withColumn("s", F.col("base") * F.pow("decay", F.col("d") / (0.1 * F.col("page_diag"))) * F.pow("letter", spare))
    rank = F.row_number().over(Window.partitionBy(*own, "rule").orderBy(F.desc("s"), "txt")) - 1
    one = scored.withColumn("k", rank).groupBy(*own, "rule", "mode").agg(F.sum(F.col("s") * F.pow("hit_decay", F.col("k").cast("double"))).alias("score"))
    is_must, is_counted = F.col("mode").isin(MUST_INCLUDE, MUST_INCLUDE_EACH), F.col("mode").isin(MAY_INCLUDE, MUST_INCLUDE)
    by = one.groupBy(*own).agg(
        F.max((F.col("mode") == MUST_EXCLUDE).cast("int")).alias("_excluded"), F.sum(is_must.cast("int")).alias("_musts"), F.max(is_counted.cast("int")).alias("_some"),
        F.sum(F.when(F.col("mode") != MUST_EXCLUDE, F.col("score"))).alias("_total"),
    )
    # what a KPI's rules ask for, known without looking at any text
    musts, counted, none = F.lit(0), F.lit(False), F.lit(False)
    for k in rules:
        this = F.col("kpi_id") == F.lit(float(k.kpi_id))
        musts = F.when(this, sum(r.mode in (MUST_INCLUDE, MUST_INCLUDE_EACH) for r in k.anywhere)).otherwise(musts)
        counted = F.when(this, any(r.mode in (MAY_INCLUDE, MUST_INCLUDE) for r in k.anywhere)).otherwise(counted)
        none = F.when(this, not k.anywhere).otherwise(none)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    excluded = zero("_excluded") > 0
    bad = excluded | (zero("_musts") < musts)
    total = F.coalesce("_total", F.lit(0.0))
    ok = ~bad & ((zero("_some") > 0) | ~counted) & (total > 0)
    score = F.when(none, 0.0).when(bad, F.when(excluded, -1.0).otherwise(0.0)).when(ok, total).otherwise(0.0)
    out = values.join(by_keys(by), own, "left").withColumn("anywhere_ok", none | ok).withColumn("anywhere_score", score)
    return out.drop("_excluded", "_musts", "_some", "_total")


def anywhere_scores(values: DataFrame, texts: DataFrame, rule: KpiRule, keys: list[str]) -> DataFrame:
    """As anywhere_matches(), for the rules of one KPI: values have no kpi_id."""
    return anywhere_matches(values.withColumn("kpi_id", F.lit(float(rule.kpi_id))), texts, [rule], keys).drop("kpi_id")
