"""Control matching as a one-to-one assignment, and the purchase history it compares.

The distance of a test card and a control card is the sum, over the numeric features, of their difference in units of the
feature's tolerance, plus one for each differing category; its mean over all features, taken from one, is the
match quality. Cards that differ in an exact feature, or whose quality is below the threshold, are no pair.

The result is the greedy assignment: of all pairs, the closest first (then the first test card, then the first control
card), each card in one pair at most. It leaves no free card with a free partner. It is reached without
listing all pairs: the radius grows. Cards with equal features are lined up; then pairs within a small radius
are found through cells of that width, settled by rounds in which cards that choose each other leave,
and only what is still free is looked at with a larger radius, up to the one that the threshold allows. As no two
free cards are closer than the radius before, no step sees many pairs, however dense the cards lie. The radii change what
a step costs, never the result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.exprs import derive, present, require
from ..sources.scratch import handed_over
from .experiment import MATCH_THRESHOLD, number_within

HISTORY_DAYS = 90
#: Numeric features that name a cell; a test card looks into 3 ** CELL_FEATURES cells.
CELL_FEATURES = 2
#: A step may look at so many pairs for each card; the radius is halved until it does, this often at most.
PAIRS_PER_CARD, HALVINGS = 64, 24
SLICES = 64
OUTERMOST = float(1 << 60)


def history_features(
    purchases: DataFrame, cards: DataFrame, as_of: dt.date, days: int = HISTORY_DAYS, key: str = "tokenized_cardmember_id",
) -> DataFrame:
    """`cards` (key, ...) with what each bought in the `days` before `as_of`, that day excluded.

    Spend, number of transactions, average ticket, and the share of purchases at the merchant and in the category the card
    uses most. Tenure is the number of whole calendar months since the card's first purchase before `as_of`. Cards without
    purchases have zeros. Both shares come from counts per (card, merchant) and (card, category): no card's purchases are
    gathered in one place.
    """
    needed = (key, "transaction_id", "merchant_id", "category_id", "transaction_date", "transaction_amount")
    before = require(purchases, needed, "purchases").filter(present(key, "transaction_date") & (F.col("transaction_date") < F.lit(as_of)))
    recent = before.filter(F.col("transaction_date") >= F.lit(as_of - dt.timedelta(days=days)))
    exact = F.rint(F.col("transaction_amount") * 100).cast("bigint")
    per_ticket = recent.groupBy(key, "transaction_id").agg(F.sum(exact).alias("cents"))
    spend = per_ticket.groupBy(key).agg(F.sum("cents").alias("__cents"), F.count("*").alias("__n"))

    def favourite(column: str, name: str) -> DataFrame:
        uses = recent.filter(F.col(column).isNotNull()).groupBy(key, column).agg(F.count("*").alias("n"))
        return uses.groupBy(key).agg((F.max("n") / F.sum("n")).alias(name))

    first = before.groupBy(key).agg(F.min("transaction_date").alias("__first"))
    joined = cards
    for part in (spend, favourite("merchant_id", "__merchant"), favourite("category_id", "__category"), first):
        joined = joined.join(part, key, "left")
    until = f"DATE '{as_of.isoformat()}'"
    return derive(joined, {
        "historical_spend_90d": "coalesce(__cents, 0L) / 100D",
        "historical_transaction_count_90d": "coalesce(__n, 0L)",
        "average_ticket_size": "CASE WHEN __n > 0 THEN __cents / 100D / __n ELSE 0D END",
        "merchant_affinity_score": "coalesce(__merchant, 0D)",
        "category_affinity_score": "coalesce(__category, 0D)",
        "customer_tenure_months":
            f"coalesce(12L * (year({until}) - year(__first)) + month({until}) - month(__first), 0L)",
    }).drop("__cents", "__n", "__merchant", "__category", "__first")


def _order(df: DataFrame, key: str) -> Column:
    """Cards are ordered by a slice of their key, then by the key."""
    number = F.xxhash64(key) if isinstance(df.schema[key].dataType, StringType) else F.col(key)
    return F.struct(F.pmod(number, F.lit(SLICES)).alias("slice"), F.col(key).alias("key"))


class _Features:
    """The features of a match, and the arithmetic on pairs of cards with columns t and c."""

    def __init__(self, exact: Sequence[str], categories: Sequence[str], tolerances: Mapping[str, float], threshold: float):
        self.exact, self.categories, self.tolerances, self.threshold = list(exact), list(categories), dict(tolerances), threshold
        self.count = len(self.exact) + len(self.categories) + len(self.tolerances)
        self.names = [*self.exact, *self.categories, *self.tolerances]
        self.radius = self.count * (1.0 - threshold)

    def distance(self) -> str:
        """SQL text, from the columns t (test card) and c (control card)."""
        parts = [f"abs(t.{f} - c.{f}) / {float(w)!r}D" for f, w in self.tolerances.items()]
        parts += [f"CASE WHEN t.{f} = c.{f} THEN 0D ELSE 1D END" for f in self.categories]
        return " + ".join(parts) or "0D"

    def quality(self) -> str:
        return f"1D - distance / {self.count}D"

    def celled(self, df: DataFrame, radius: float, look: bool) -> DataFrame:
        """`df` with its cell for a radius; with `look`, repeated for the cells around it.

        A cell is a little wider than the radius, so that rounding can't part a pair by two cells.
        """
        names = list(self.tolerances)[:CELL_FEATURES]
        for i, f in enumerate(names):
            # Numbers too far out for a cell of their own share the outermost one.
            place = F.col(f"card.{f}") / F.lit(radius * self.tolerances[f] * (1 + 1e-9))
            cell = F.floor(F.least(F.greatest(place, F.lit(-OUTERMOST)), F.lit(OUTERMOST)))
            df = df.withColumn(f"cell{i}", F.explode(F.array(cell - 1, cell, cell + 1)) if look else cell)
        return df.withColumns({f"exact{i}": F.col(f"card.{f}") for i, f in enumerate(self.exact)})

    @property
    def meeting(self) -> list[str]:
        return [*(f"exact{i}" for i in range(len(self.exact))), *(f"cell{i}" for i in range(min(CELL_FEATURES, len(self.tolerances))))]


def assign_controls(
    test: DataFrame, control: DataFrame, exact: Sequence[str], categories: Sequence[str], tolerances: Mapping[str, float],
    key: str = "tokenized_cardmember_id", threshold: float = MATCH_THRESHOLD,
) -> DataFrame:
    """test_<key>, control_<key>, distance, match_quality_score of every pair of the greedy assignment.

    Cards with a null feature, or a feature that is no finite number, have no distance and stay free. `key` is unique on
    either side. A card on both sides may be its own control: leave it out of one side to rule that out.
    """
    features = _Features(exact, categories, tolerances, threshold)

    def cards(df: DataFrame) -> DataFrame:
        sound = present(key, *features.names)
        for f in features.tolerances:
            sound = sound & (F.abs(F.col(f).cast("double")) < float("inf"))
        return df.filter(sound).select(_order(df, key).alias("at"), F.struct(key, *features.names).alias("card"))

    free_t, free_c = handed_over(cards(test), "test-cards"), handed_over(cards(control), "control-cards")
    settled = [_lined_up(free_t, free_c, features)]
    last = HALVINGS + 1 if features.radius > 0 else 0
    while last > 0:
        free_t = handed_over(_without(free_t, settled[-1], "t"), "free-test")
        free_c = handed_over(_without(free_c, settled[-1], "c"), "free-control")
        last = _next_radius(free_t, free_c, features, last)
        settled.append(_settled(free_t, free_c, features, last))
    pairs = settled[0]
    for part in settled[1:]:
        pairs = pairs.unionByName(part)
    return derive(pairs, {"match_quality_score": features.quality()}).select(
        F.col("t.key").alias(f"test_{key}"), F.col("c.key").alias(f"control_{key}"), "distance", "match_quality_score")


def _without(free: DataFrame, pairs: DataFrame, side: str) -> DataFrame:
    return free.join(pairs.select(F.col(f"{side}.key").alias("__gone")), F.col("at.key") == F.col("__gone"), "left_anti")


def _lined_up(test: DataFrame, control: DataFrame, features: _Features) -> DataFrame:
    """Pairs (t, c, distance) of cards with equal features: the first test card with the first control card, and so on.

    Groups of equal cards, which may hold a large part of all, are numbered in slices and joined on the number.
    """
    names = [f"__f{i}" for i in range(len(features.names))]

    def numbered(df: DataFrame, side: str) -> DataFrame:
        flat = df.select(F.col("at.key").alias("key"), "at", *(F.col(f"card.{f}").alias(n) for f, n in zip(features.names, names)))
        return number_within(flat, names, "key", SLICES).select(*names, "position", F.col("at").alias(side))

    return handed_over(
        numbered(test, "t").join(numbered(control, "c"), [*names, "position"]).select("t", "c", F.lit(0.0).alias("distance")), "equal-cards")


def _next_radius(test: DataFrame, control: DataFrame, features: _Features, last: int) -> int:
    """The number of halvings of the full radius, below `last`, at which the cells hold few enough pairs.

    Pairs are counted from the cells' sizes, none is built. At the end of the scale the step is taken as it is.
    """
    cards = test.count() + control.count()
    for halvings in range(last):
        radius = features.radius / 2 ** halvings
        sizes = [features.celled(df, radius, look).groupBy(*features.meeting).agg(F.count("*").alias(n))
                 for df, look, n in ((test, True, "n"), (control, False, "m"))]
        pairs = sizes[0].join(sizes[1], features.meeting).agg(F.sum(F.col("n").cast("double") * F.col("m"))).first()[0] or 0.0
        if pairs <= PAIRS_PER_CARD * cards:
            return halvings
    return last - 1


def _settled(test: DataFrame, control: DataFrame, features: _Features, halvings: int) -> DataFrame:
    """Pairs (t, c, distance) of the greedy assignment within a radius: rounds of mutual best choice.

    The full radius is what the threshold says; rounding must not decide it a second time.
    """
    radius = features.radius / 2 ** halvings
    inside = f"{features.quality()} >= {features.threshold!r}D" + (f" AND distance <= {radius!r}D" if halvings else "")
    left = features.celled(test.select(F.col("at").alias("t"), "card"), radius, True).withColumnRenamed("card", "t_card")
    right = features.celled(control.select(F.col("at").alias("c"), "card"), radius, False).withColumnRenamed("card", "c_card")
    near = left.join(right, features.meeting)
    distance = features.distance().replace("t.", "t_card.").replace("c.", "c_card.")
    pairs = derive(near, {"distance": distance}).filter(inside)
    open_pairs = handed_over(pairs.select("t", "c", "distance"), "near-pairs")
    chosen = []
    while not open_pairs.isEmpty():
        best_t = open_pairs.groupBy("t").agg(F.min(F.struct("distance", "c")).alias("best")).select("t", F.col("best.c").alias("c"))
        best_c = open_pairs.groupBy("c").agg(F.min(F.struct("distance", "t")).alias("best")).select("c", F.col("best.t").alias("t"), F.col("best.distance").alias("distance"))
        mutual = handed_over(best_t.join(best_c, ["t", "c"]).select("t", "c", "distance"), "mutual-pairs")
        chosen.append(mutual)
        rest = open_pairs.join(mutual.select("t"), "t", "left_anti").join(mutual.select("c"), "c", "left_anti")
        open_pairs = handed_over(rest.select("t", "c", "distance"), "open-pairs")
    out = open_pairs
    for part in chosen:
        out = out.unionByName(part)
    return handed_over(out, "settled-pairs")
