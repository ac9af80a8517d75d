"""Exact top-k search by a three-phase uniform threshold.

A vector's score with a query is the sum of its local scores on ``nodes``: slices of the components. Phase
one gathers the local score lists' heads and resolves them, which gives each query a safe cutoff: k scores
reach it. Phase two sends the cutoff out, and every node returns all entries with at least its equal share
of it; a vector below its share on every node can't reach the cutoff. Phase three resolves what came back.
Queries and vectors meet in blocks of bounded size. Equal vectors are searched once.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from bazaarlens import session

_STEP = 256  # queries scored at a time in a task


def quantized(vectors: DataFrame, id_column: str, vector_column: str, scale: int = 64) -> DataFrame:
    """row, vec_id and v: floor(scale * x) of every component x as a double.

    Rows with a NULL id, a NULL or empty vector, or a NULL or non-finite component are left out.
    """
    x = F.transform(vector_column, lambda c: c.cast("double"))
    whole = F.col(id_column).isNotNull() & (F.size(vector_column) > 0) & F.forall(
        x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vectors.filter(F.coalesce(whole, F.lit(False))).select(
        F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of all rows of a and b; in doubles where every sum fits them."""
    top = lambda m: int(np.abs(m).max(initial=0))
    if top(a) * top(b) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Blocks:
    """Distinct vectors (okey, v) and query vectors (qkey, v), dealt into blocks of bounded size."""

    def __init__(self, objects: DataFrame, queries: DataFrame, nodes: int, block_rows: int, block_queries: int):
        self.nodes = nodes
        self.b = max(1, -(-objects.count() // block_rows))
        self.q = max(1, -(-queries.count() // block_queries))
        self.objects, self.queries = objects, queries

    def _in(self, key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def query_side(self, queries: DataFrame) -> DataFrame:
        """Query vectors with their block ``qb``, once for each block ``ob`` of vectors; ``dim`` keeps sizes apart."""
        return (queries.withColumn("qb", self._in("qkey", self.q)).withColumn("dim", F.size("v"))
                .withColumn("ob", F.explode(F.sequence(F.lit(0), F.lit(self.b - 1)))))

    def object_side(self) -> DataFrame:
        return (self.objects.withColumn("ob", self._in("okey", self.b)).withColumn("dim", F.size("v"))
                .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(self.q - 1)))))

    def sliced(self, side: DataFrame) -> DataFrame:
        """Every node's slice of the vectors."""
        edge = lambda i: F.floor(F.col("dim") * i / self.nodes).cast("int")
        slices = F.array(*(F.struct(F.lit(i).alias("node"), F.slice("v", edge(i) + 1, edge(i + 1) - edge(i)).alias("part")) for i in range(self.nodes)))
        return side.withColumn("x", F.explode(slices)).drop("v").select("*", "x.node", "x.part").drop("x").filter(F.size("part") > 0)

    def on_nodes(self, queries: DataFrame, run, schema: str) -> DataFrame:
        key = ["node", "dim", "qb", "ob"]
        return (self.sliced(self.query_side(queries)).groupBy(*key).cogroup(self.sliced(self.object_side()).groupBy(*key))
                .applyInPandas(run, schema))

    def resolve(self, pairs: DataFrame) -> DataFrame:
        """qkey, okey and the whole score of the given pairs."""
        key = ["qb", "ob"]
        both = (self.query_side(self.queries).select(*key, "qkey", F.lit(None).cast("long").alias("okey"), "v")
                .unionByName(self.object_side().select(*key, F.lit(None).cast("long").alias("qkey"), "okey", "v")))
        asked = pairs.select("qkey", "okey", self._in("qkey", self.q).alias("qb"), self._in("okey", self.b).alias("ob"))

        def run(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
            if not len(asked):
                return pd.DataFrame({"qkey": [], "okey": [], "score": []}, dtype="int64")
            of = {name: {k: i for i, k in enumerate(held[name].dropna().astype(np.int64))} for name in ("qkey", "okey")}
            width = int(held["v"].map(len).max())
            data = {}
            for name in ("qkey", "okey"):
                data[name] = np.zeros((len(of[name]), width), np.int64)
                for i, v in enumerate(held.loc[held[name].notna(), "v"]):
                    data[name][i, :len(v)] = v
            i = asked["qkey"].map(of["qkey"]).to_numpy()
            j = asked["okey"].map(of["okey"]).to_numpy()
            score = np.empty(len(asked), np.int64)
            for a in range(0, len(asked), 1 << 16):
                part = slice(a, a + (1 << 16))
                score[part] = np.einsum("ij,ij->i", data["qkey"][i[part]], data["okey"][j[part]])
            return pd.DataFrame({"qkey": asked["qkey"], "okey": asked["okey"], "score": score})

        return asked.groupBy(*key).cogroup(both.groupBy(*key)).applyInPandas(run, "qkey long, okey long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int, nodes: int = 2, block_rows: int = 8192, block_queries: int = 1024) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of each query with every row but its own.

    ``vectors`` is a stored table (row, vec_id, v); ``is_query`` picks the queries by its columns. Ties go to
    the smaller vec_id. Only vectors of a query's own length are scored. Fewer than k rows give as many
    results, an empty table none. Repeated ids are separate rows, as queries and as candidates.
    """
    order = W.Window.partitionBy("v").orderBy("vec_id", "row")
    # Of equal vectors a query can need the first k besides its own row.
    objects = session.cut(vectors.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
                          .groupBy("v").agg(F.sort_array(F.collect_list(F.struct("vec_id", "row"))).alias("ids"))
                          .withColumn("okey", F.col("ids")[0]["row"]))
    asking = session.cut(vectors.filter(is_query).join(objects.select("v", F.col("okey").alias("qkey")), "v")
                         .select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), "qkey"))
    queries = session.cut(objects.select(F.col("okey").alias("qkey"), "v").join(asking.select("qkey"), "qkey", "left_semi"))
    blocks = Blocks(objects.select("okey", "v"), queries, nodes, block_rows, block_queries)
    wanted = k + 1  # distinct vectors: the query's own may be among them

    def heads(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            a, b, okey = _matrix(asked["part"]), _matrix(held["part"]), held["okey"].to_numpy()
            n = min(wanted, len(b))
            for i in range(0, len(a), _STEP):
                local = _product(a[i:i + _STEP], b)
                best = np.argpartition(-local, n - 1, axis=1)[:, :n]
                out.append(pd.DataFrame({"qkey": np.repeat(asked["qkey"].to_numpy()[i:i + _STEP], n), "node": asked["node"].iloc[0],
                                         "okey": okey[best].ravel(), "local": np.take_along_axis(local, best, 1).ravel()}))
        return pd.concat(out) if out else pd.DataFrame({"qkey": [], "node": [], "okey": [], "local": []}, dtype="int64")

    lists = blocks.on_nodes(queries, heads, "qkey long, node int, okey long, local long")
    place = F.row_number().over(W.Window.partitionBy("qkey", "node").orderBy(F.desc("local"), "okey"))
    gathered = lists.withColumn("n", place).filter(F.col("n") <= wanted).select("qkey", "okey").distinct()
    known = session.cut(blocks.resolve(gathered))
    place = F.row_number().over(W.Window.partitionBy("qkey").orderBy(F.desc("score")))
    cutoff = known.withColumn("n", place).filter(F.col("n") == wanted).select("qkey", F.col("score").alias("cutoff"))
    sent = queries.join(cutoff, "qkey")  # a query without a cutoff has seen every vector already

    def sufficient(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(held):
            a, b, okey, qkey = _matrix(asked["part"]), _matrix(held["part"]), held["okey"].to_numpy(), asked["qkey"].to_numpy()
            share = -(-asked["cutoff"].to_numpy() // np.minimum(asked["dim"].to_numpy(), nodes))  # nodes with a slice of the vector
            for i in range(0, len(a), _STEP):
                x, y = np.nonzero(_product(a[i:i + _STEP], b) >= share[i:i + _STEP, None])
                out.append(pd.DataFrame({"qkey": qkey[i + x], "okey": okey[y]}))
        return pd.concat(out) if out else pd.DataFrame({"qkey": [], "okey": []}, dtype="int64")

    collected = blocks.on_nodes(sent, sufficient, "qkey long, okey long").distinct()
    scored = blocks.resolve(collected).join(cutoff, "qkey").filter("score >= cutoff").select("qkey", "okey", "score")
    few = known.join(cutoff, "qkey", "left_anti")
    hits = scored.unionByName(few).join(objects.select("okey", "ids"), "okey")
    rows = (asking.join(hits, "qkey").select("query_row", "query_id", "score", F.inline("ids"))
            .filter(F.col("row") != F.col("query_row")))
    rank = F.row_number().over(W.Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return rows.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
