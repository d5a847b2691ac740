"""RFM features and customer segments.

K-means runs on one row per customer. Its rows are written once (``checkpoint``) and cached while the centres
move, so a lost executor costs a re-read, not the fact aggregation. All starts for all numbers of clusters share each pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from salesloom.functions.ratios import div, round_half_up
from salesloom.session import shared_dir

FEATURES = ["recency", "frequency", "monetary"]


def rfm(fact: DataFrame) -> DataFrame:
    """Days since the last order (counted from the last date in the data), distinct orders, revenue."""
    today = fact.agg(F.max("order_date").alias("d")).scalar()
    return (
        fact.filter("customer_id IS NOT NULL").groupBy("customer_id")
        .agg(F.max("order_date").alias("_last"), F.count_distinct("order_id").alias("frequency"),
             F.coalesce(F.sum("revenue"), F.lit(0)).alias("monetary"))
        .select(
            "customer_id", F.greatest(F.datediff(today, "_last"), F.lit(0)).alias("recency"), "frequency",
            F.greatest(F.col("monetary"), F.lit(0)).cast("double").alias("monetary"),
        )
    )


def scaled(customers: DataFrame) -> DataFrame:
    """R2: log1p of the features, centred and scaled to unit deviation, as the vector column ``features``.

    Spark divides by the sample deviation; against the population deviation that is one common factor on all
    features, which leaves the clusters as they are.
    """
    logged = customers.withColumns({f"_log_{c}": F.log1p(F.col(c).cast("double")) for c in FEATURES})
    vector = VectorAssembler(inputCols=[f"_log_{c}" for c in FEATURES], outputCol="_raw").transform(logged)
    scaler = StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True).fit(vector)
    return scaler.transform(vector).select(*customers.columns, "features")


def scaled_columns(customers: DataFrame, digits: int = 6) -> DataFrame:
    """R2 as plain columns, rounded."""
    from pyspark.ml.functions import vector_to_array
    values = scaled(customers.checkpoint()).withColumn("v", vector_to_array("features"))
    return values.select("customer_id", *[F.round(F.col("v")[i], digits).alias(f"{c}_scaled") for i, c in enumerate(FEATURES)])


def by_spend(customers: DataFrame, limits: Sequence[float]) -> DataFrame:
    """Segments by fixed limits of revenue, highest first: a segmentation that needs no fitting."""
    segment = F.lit(len(limits))
    for k, limit in reversed(list(enumerate(limits))):
        segment = F.when(F.col("monetary") >= limit, k).otherwise(segment)
    return customers.withColumn("segment", segment.cast("long"))


@dataclass(frozen=True)
class Segmentation:
    best_k: int
    scores: dict[int, float]  # silhouette per k
    costs: dict[int, float]  # within-cluster sum of squares per k
    assigned: DataFrame  # customer_id, recency, frequency, monetary, segment

    def score_table(self) -> DataFrame:
        """R3 as a table: one row per tried k."""
        schema = T.StructType([
            T.StructField("k", T.LongType()), T.StructField("silhouette", T.DoubleType()),
            T.StructField("cost", T.DoubleType()), T.StructField("chosen", T.BooleanType()),
        ])
        rows = [(k, self.scores[k], self.costs[k], k == self.best_k) for k in sorted(self.scores)]
        return self.assigned.sparkSession.createDataFrame(rows, schema)


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1) for each id that does not depend on how the rows are dealt out."""
    x = ids.astype(np.uint64) + np.uint64(salt * 0x9E3779B97F4A7C15 % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) + 0.5) / 2.0**53


def _matrix(b: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    return np.column_stack([b[c].to_numpy() for c in columns])


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each centre."""
    return ((x[:, None] - centres[None]) ** 2).sum(2)


class Starts:
    """K-means from many starts at once: each pass over the customers moves the centres of all starts that still move.

    What a task sends is one row for each start and cluster, so a pass costs the same shuffle whatever the number of customers.
    """

    def __init__(self, points: DataFrame, ks: Sequence[int], n_init: int, seed: int):
        self.points, self.ks = points, [k for k in ks for _ in range(n_init)]
        self.columns = [c for c in points.columns if c.startswith("x")]
        self.seed = seed
        self.centres = [np.zeros((0, len(self.columns))) for _ in self.ks]
        self.costs = np.zeros(len(self.ks))

    def spread(self) -> None:
        """First centres: each the next with a chance in proportion to its squared distance from those before (k-means++).

        A row's key is ln(u) / distance with a uniform u of its own, and the largest key wins, so a draw is a maximum over all rows.
        """
        for step in range(max(self.ks)):
            open_ = {i: c for i, c in enumerate(self.centres) if len(c) < self.ks[i]}
            seed, columns = self.seed, self.columns

            def run(batches, open_=open_, step=step):
                best: dict[int, tuple] = {}
                for b in batches:
                    x, ids = _matrix(b, columns), b["customer_id"].to_numpy()
                    for i, c in open_.items() if len(x) else ():
                        d = _squared(x, c).min(1) if len(c) else np.ones(len(x))
                        with np.errstate(divide="ignore"):
                            key = np.where(d > 0, np.log(_uniform(ids, seed * 100_003 + i * 101 + step)) / d, -np.inf)
                        at = int(np.argmax(key))
                        best[i] = max(best.get(i, (-np.inf,)), (float(key[at]), *x[at].tolist()))
                rows = [(i, *v) for i, v in best.items() if len(v) > 1]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)] if rows else [pa.array([], t) for t in kinds], names)

            names, kinds = ["start", "key", *self.columns], [pa.int64(), *[pa.float64()] * (len(self.columns) + 1)]
            drawn = self.points.mapInArrow(run, ", ".join(f"{c} {'long' if c == 'start' else 'double'}" for c in names)).groupBy("start").agg(
                F.max(F.struct("key", *self.columns)).alias("m")).collect()
            for r in drawn:
                self.centres[r["start"]] = np.vstack([self.centres[r["start"]], list(r["m"])[1:]])

    def move(self, moving: set[int]) -> dict[int, np.ndarray]:
        """New centres of the starts in ``moving``; their costs before the move are kept."""
        centres, columns = {i: self.centres[i] for i in moving}, self.columns

        def run(batches):
            total = {i: np.zeros((len(c), len(columns) + 2)) for i, c in centres.items()}
            for b in batches:
                x = _matrix(b, columns)
                for i, c in centres.items() if len(x) else ():
                    d = _squared(x, c)
                    near = d.argmin(1)
                    for j, v in enumerate((*x.T, d.min(1), np.ones(len(x)))):
                        total[i][:, j] += np.bincount(near, weights=v, minlength=len(c))
            start = np.repeat(list(total), [len(t) for t in total.values()])
            cluster = np.concatenate([np.arange(len(t)) for t in total.values()])
            yield pa.RecordBatch.from_arrays([pa.array(start.astype(np.int64)), pa.array(cluster), *map(pa.array, np.concatenate(list(total.values())).T)], names)

        sums = [*self.columns, "cost", "n"]
        names = ["start", "cluster", *sums]
        out = {i: c.copy() for i, c in centres.items()}
        costs = dict.fromkeys(moving, 0.0)
        kinds = ", ".join(f"{c} {'long' if c in ('start', 'cluster') else 'double'}" for c in names)
        for r in self.points.mapInArrow(run, kinds).groupBy("start", "cluster").agg(*[F.sum(c).alias(c) for c in sums]).collect():
            costs[r["start"]] += r["cost"]
            if r["n"]:
                out[r["start"]][r["cluster"]] = [r[c] / r["n"] for c in self.columns]
        for i, v in costs.items():
            self.costs[i] = v
        return out

    def fit(self, tolerance: float = 1e-4, most: int = 20) -> None:
        """Move until no centre of a start moves by more than ``tolerance``; costs are those of the last centres."""
        self.spread()
        moving = set(range(len(self.ks)))
        for _ in range(most):
            new = self.move(moving)
            moving = {i for i in moving if len(new[i]) and np.sqrt(((new[i] - self.centres[i]) ** 2).sum(1)).max() > tolerance}
            for i, c in new.items():
                self.centres[i] = c
            if not moving:
                break
        self.move(set(range(len(self.ks))))

    def best(self) -> dict[int, int]:
        """The cheapest start of each k."""
        return {k: min((i for i, own in enumerate(self.ks) if own == k), key=lambda i: self.costs[i]) for k in dict.fromkeys(self.ks)}

    def assigned(self, starts: Mapping[int, int]) -> DataFrame:
        """The points with a column ``s<k>`` for the cluster under each of ``starts``."""
        centres, columns = {f"s{k}": self.centres[i] for k, i in starts.items()}, self.columns

        def run(batches):
            for b in batches:
                x = _matrix(b, columns)
                yield pa.RecordBatch.from_arrays([*[b[c] for c in b.schema.names], *[pa.array(_squared(x, c).argmin(1).astype(np.float64)) for c in centres.values()]],
                                                 [*b.schema.names, *centres])

        return self.points.mapInArrow(run, T.StructType([*self.points.schema.fields, *[T.StructField(c, T.DoubleType()) for c in centres]]))


def segment(customers: DataFrame, ks: Sequence[int] = range(2, 7), n_init: int = 10, seed: int = 42) -> Segmentation:
    """For each k keep the cheapest of ``n_init`` starts, choose the k with the best silhouette.

    Only centres and scores reach the driver. Cluster numbers are arbitrary, so segments are numbered from
    the highest mean revenue down. The silhouette uses squared Euclidean distance.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    shared_dir(customers.sparkSession)
    values = scaled(customers.checkpoint()).withColumn("v", vector_to_array("features"))
    points = values.select("customer_id", *[F.col(c).cast("double").alias(c) for c in FEATURES],
                           *[F.col("v")[i].alias(f"x{i}") for i in range(len(FEATURES))]).checkpoint().persist()
    starts = Starts(points, ks, n_init, seed)
    starts.fit()
    chosen = starts.best()
    costs = {k: float(starts.costs[i]) for k, i in chosen.items()}
    found = starts.assigned(chosen).withColumn("features", array_to_vector(F.array(*starts.columns))).persist()
    with ThreadPoolExecutor(max_workers=len(chosen)) as pool:  # independent Spark jobs
        scores = dict(zip(chosen, pool.map(lambda k: ClusteringEvaluator(featuresCol="features", predictionCol=f"s{k}").evaluate(found), chosen)))
    best = max(scores, key=scores.get)
    found_ = found.withColumn("segment", F.col(f"s{best}"))
    order = (
        found_.groupBy("segment").agg(F.avg("monetary").alias("_m"))
        .select("segment", (F.row_number().over(W.orderBy(F.desc("_m"), "segment")) - 1).alias("_no"))
    )
    kinds = {f.name: f.dataType for f in customers.schema.fields}
    assigned = found_.join(order, "segment").select(
        "customer_id", *[F.col(c).cast(kinds[c]).alias(c) for c in FEATURES], F.col("_no").alias("segment")).checkpoint()
    found.unpersist()
    points.unpersist()
    return Segmentation(best, scores, costs, assigned)


def invariants(found: Segmentation, customers: DataFrame) -> DataFrame:
    """What any right fit satisfies, in one row: everyone is in one segment, segments are numbered from the highest mean
    revenue down without a gap, the cost falls with k, the best silhouette was chosen."""
    ks = sorted(found.costs)
    falls = all(found.costs[b] <= found.costs[a] * (1 + 1e-9) for a, b in zip(ks, ks[1:]))
    means = found.assigned.groupBy("segment").agg(F.avg("monetary").alias("m"))
    order = means.select("segment", F.row_number().over(W.orderBy(F.desc("m"), "segment")).alias("r")).agg(
        F.count_if(F.col("segment") != F.col("r") - 1).alias("wrong")).scalar()
    missed = customers.join(found.assigned, "customer_id", "left_anti").agg(F.count(F.lit(1))).scalar()
    return found.assigned.agg(
        F.count("customer_id").alias("assigned"), F.count_distinct("customer_id").alias("customers"), missed.alias("missed"),
        order.alias("misnumbered"), (F.count_distinct("segment") == found.best_k).alias("all_segments_used")).withColumns({
            "cost_falls": F.lit(falls), "best_chosen": F.lit(found.scores[found.best_k] == max(found.scores.values()))})


def profile(assigned: DataFrame) -> DataFrame:
    """Size and averages per segment."""
    def avg(c: str) -> Column:
        return round_half_up(div(F.sum(c), F.count(c)), 1)

    return assigned.groupBy("segment").agg(
        F.count("customer_id").alias("customers"), avg("recency").alias("avg_recency"),
        avg("frequency").alias("avg_frequency"), avg("monetary").alias("avg_monetary"),
        round_half_up(F.sum("monetary"), 1).alias("total_revenue"),
    ).orderBy(F.desc("avg_monetary"), "segment")


def labelled(profiles: DataFrame) -> DataFrame:
    """Names by rule. Quantiles run over the segment rows (a handful), not over customers."""
    everyone = W.partitionBy()

    def quantile(c: str, q: float) -> Column:
        return F.percentile(c, q).over(everyone)

    m, f, r = F.col("avg_monetary"), F.col("avg_frequency"), F.col("avg_recency")
    limits = profiles.withColumns({
        "_m75": quantile("avg_monetary", 0.75), "_f50": quantile("avg_frequency", 0.5), "_r50": quantile("avg_recency", 0.5),
    })
    label = (
        F.when(m > F.col("_m75"), "High Value").when(f > F.col("_f50"), "Loyal")
        .when((r > F.col("_r50")) & (f == 1), "Churned").when((r < F.col("_r50")) & (f <= 2), "New / Low Engagement")
        .otherwise("At Risk")
    )
    return limits.withColumn("label", label).select(*profiles.columns, "label")


def export_columns(assigned: DataFrame) -> DataFrame:
    """R7."""
    return assigned.select("customer_id", "segment", *FEATURES)
