"""Individual-level association: marker and sample checks, kinship, components, and a mixed model."""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sorrel.functions.numeric import bounded_minimum, log_t_sf
from sorrel.operators.contract import ContractError, DuplicateError, set_differences


def marker_checks(long: DataFrame, min_maf: float = 0.01, max_missing: float = 0.1) -> DataFrame:
    """Calls, ALT frequency, missing share and the reasons for exclusion (empty: kept) of each marker. `long`: sample_id, marker_id, dosage (0, 1, 2 or null)."""
    per = long.groupBy("marker_id").agg(F.count("dosage").alias("n_called"), F.count("*").alias("n_samples"), F.sum("dosage").alias("total"))
    per = per.withColumns({"alt_frequency": F.when(F.col("n_called") > 0, F.col("total") / (2 * F.col("n_called"))), "missing": 1 - F.col("n_called") / F.col("n_samples")})
    maf = F.least("alt_frequency", 1 - F.col("alt_frequency"))
    reasons = F.concat_ws(";", F.when(F.col("n_called") == 0, "no_calls"), F.when(maf == 0, "monomorphic"), F.when((maf < min_maf) & (maf > 0), "low_maf"), F.when(F.col("missing") > max_missing, "missingness"))
    return per.select("marker_id", "n_called", "alt_frequency", "missing", reasons.alias("reasons"))


def sample_checks(long: DataFrame, max_missing: float = 0.1) -> DataFrame:
    per = long.groupBy("sample_id").agg((1 - F.count("dosage") / F.count("*")).alias("missing"))
    return per.withColumn("ok", F.col("missing") <= max_missing)


def centred(long: DataFrame, checks: DataFrame) -> DataFrame:
    """Kept markers with missing calls set to the mean, and centred: z = dosage - 2 p."""
    kept = checks.where("reasons = ''").select("marker_id", "alt_frequency")
    twice = 2 * F.col("alt_frequency")
    return long.join(kept, "marker_id").select("sample_id", "marker_id", "alt_frequency", (F.coalesce(F.col("dosage").cast("double"), twice) - twice).alias("z"))


#: Products of a pair of tiles that one task adds up.
FAN = 16
#: Rows that leave a task at a time.
STEP = 1 << 18


def _from_least(x: np.ndarray):
    """Places of the values of `x` from the least to the greatest, `STEP` at a time. Values that differ in their last bits only may change places: a value's leading bits and its place are sorted as one number, in half the memory and a
    quarter of the time of an argsort."""
    bits = max(1, (len(x) - 1).bit_length())
    key = x.view(np.int64).copy()
    for s in range(0, len(key), STEP):
        part = key[s : s + STEP]
        part ^= (part >> 63) & np.iinfo(np.int64).max
        part >>= bits
        part <<= bits
        part |= np.arange(s, s + len(part))
    key.sort()
    for s in range(0, len(key), STEP):
        yield key[s : s + STEP] & ((1 << bits) - 1)


def kinship(z: DataFrame, tile: int = 512, block: int = 1024, wide: int = 4096) -> DataFrame:
    """sample_a, sample_b (a <= b) and k = sum z_a z_b / sum 2 p (1 - p).

    Samples are dealt to tiles, markers to blocks of about `block`, and the values of a tile and block are packed into one matrix. With one block, a task gets the two matrices of a pair of tiles (about `wide` samples each, fewer if
    that leaves too few tasks), and its sums leave it as rows, from the least sum to the greatest: no product is shuffled, a sample's values travel once for each tile, and in a columnar file equal sums stand together, so most of a row are the
    two places in its tiles. With more blocks, tiles have about `tile` samples, each pair multiplies its matrices of a block, and the products of a pair are added up as a tree, `FAN` at a time: no task holds more than that many tiles, however
    many markers there are. The rows are the square of the samples in any case.
    """
    sizes = z.agg(F.countDistinct("sample_id").alias("samples"), F.countDistinct("marker_id").alias("markers")).first()
    tiles, blocks = max(1, -(-sizes.samples // tile)), max(1, -(-sizes.markers // block))
    if blocks == 1:
        tasks = int(z.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tiles = max(1, -(-sizes.samples // wide), min(tiles, math.isqrt(2 * tasks) + 1))
    scale = z.select("marker_id", "alt_frequency").distinct().agg(F.sum(2 * F.col("alt_frequency") * (1 - F.col("alt_frequency"))).alias("scale"))
    rows = z.select("sample_id", "marker_id", "z", F.pmod(F.xxhash64("sample_id"), F.lit(tiles)).cast("int").alias("tile"), F.pmod(F.xxhash64("marker_id"), F.lit(blocks)).cast("int").alias("block"))
    kinds = dict(z.dtypes)
    kind, marker = kinds["sample_id"], kinds["marker_id"]

    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, tile = key
        (ids, at), (markers, column) = (np.unique(pdf[c].to_numpy(), return_inverse=True) for c in ("sample_id", "marker_id"))
        x = np.zeros((len(ids), len(markers)))
        x[at, column] = pdf["z"].to_numpy()
        # a marker has few values, so their numbers, marker by marker, are a small part of the matrix that travels to each other tile
        values, codes = np.unique(x.T, return_inverse=True)
        codes = zlib.compress(codes.astype(np.min_scalar_type(len(values))).tobytes(), 1)
        return pd.DataFrame({"block": [block], "tile": [tile], "ids": [ids.tolist()], "markers": [markers.tolist()], "values": [values.tobytes()], "codes": [codes]})

    packed = rows.groupBy("block", "tile").applyInPandas(pack, f"block int, tile int, ids array<{kind}>, markers array<{marker}>, values binary, codes binary")
    pairs = packed.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1)))).withColumns({"low": F.least("tile", "other"), "high": F.greatest("tile", "other")}).drop("other")

    def matrix_of(r) -> np.ndarray:
        values = np.frombuffer(r.values)
        return values[np.frombuffer(zlib.decompress(r.codes), np.min_scalar_type(len(values)))].reshape(-1, len(r.ids)).T

    def matrices(rows) -> dict:
        return {r.tile: (list(r.ids), np.asarray(r.markers), matrix_of(r)) for r in rows}

    def multiplied(own: dict, low: int, high: int):
        (a, ma, xa), (b, mb, xb) = own[low], own[high]
        _, i, j = np.intersect1d(ma, mb, return_indices=True)
        return a, b, xa[:, i], xb[:, j].T

    def named(ids_a: np.ndarray, ids_b: np.ndarray, k: np.ndarray, a: np.ndarray, b: np.ndarray) -> pd.DataFrame:
        x, y = ids_a[a], ids_b[b]
        return pd.DataFrame({"sample_a": np.where(x <= y, x, y), "sample_b": np.where(x <= y, y, x), "part": k[a, b]})

    def at_once(batches):
        own, now = [], None
        for batch in batches:
            for r in batch.to_pandas().itertuples():
                if (r.low, r.high) != now:
                    yield from ordered(own, now)
                    own, now = [], (r.low, r.high)
                own.append(r)
        yield from ordered(own, now)

    def ordered(rows, pair):
        if pair is None or not {*pair} <= {r.tile for r in rows}:
            return
        a, b, x, y = multiplied(matrices(rows), *pair)
        ids, at = np.unique(np.concatenate([np.asarray(a), np.asarray(b)]), return_inverse=True)
        ids, left, right, k = pa.array(ids), at[: len(a)], at[len(a) :], (x @ y).ravel()
        for place in _from_least(k):
            i, j = np.divmod(place, len(b))
            if pair[0] == pair[1]:
                place, i, j = (v[i <= j] for v in (place, i, j))
            i, j = left[i], right[j]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.minimum(i, j))), ids.take(pa.array(np.maximum(i, j))), pa.array(k[place])], ["sample_a", "sample_b", "part"])

    if blocks == 1:
        number = F.expr("cast(high * (high + 1) div 2 + low as int)")
        dealt = pairs.repartitionById(tiles * (tiles + 1) // 2, number).sortWithinPartitions("low", "high")
        sums = dealt.mapInArrow(at_once, f"sample_a {kind}, sample_b {kind}, part double")
        return sums.crossJoin(scale).select("sample_a", "sample_b", (F.col("part") / F.col("scale")).alias("k"))

    def product(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        block, low, high = key
        own = matrices(pdf.itertuples())
        if low not in own or high not in own:
            return pd.DataFrame({c: [] for c in ("block", "low", "high", "ids_a", "ids_b", "product")})
        a, b, x, y = multiplied(own, low, high)
        return pd.DataFrame({"block": [block], "low": [low], "high": [high], "ids_a": [a], "ids_b": [b], "product": [(x @ y).tobytes()]})

    def total(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids_a, ids_b = (np.unique(np.concatenate([np.asarray(v) for v in pdf[c]])) for c in ("ids_a", "ids_b"))
        k = np.zeros((len(ids_a), len(ids_b)))
        for a, b, part in zip(pdf["ids_a"], pdf["ids_b"], pdf["product"], strict=True):
            k[np.ix_(np.searchsorted(ids_a, a), np.searchsorted(ids_b, b))] += np.frombuffer(part).reshape(len(a), len(b))
        return ids_a, ids_b, k

    def joined(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (block, low, high), (a, b, k) = key, total(pdf)
        return pd.DataFrame({"block": [block], "low": [low], "high": [high], "ids_a": [a.tolist()], "ids_b": [b.tolist()], "product": [k.tobytes()]})

    def spread(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (low, high), (ids_a, ids_b, k) = key, total(pdf)
        a, b = np.triu_indices(len(ids_a)) if low == high else (x.ravel() for x in np.indices(k.shape))
        return named(ids_a, ids_b, k, a, b)

    tile_schema = f"block int, low int, high int, ids_a array<{kind}>, ids_b array<{kind}>, product binary"
    parts = pairs.groupBy("block", "low", "high").applyInPandas(product, tile_schema)
    while blocks > FAN:
        blocks = -(-blocks // FAN)
        parts = parts.withColumn("block", (F.col("block") / FAN).cast("int")).groupBy("block", "low", "high").applyInPandas(joined, tile_schema)
    sums = parts.groupBy("low", "high").applyInPandas(spread, f"sample_a {kind}, sample_b {kind}, part double")
    return sums.crossJoin(scale).select("sample_a", "sample_b", (F.col("part") / F.col("scale")).alias("k"))


def matrix(pairs: DataFrame, most: int = 1000) -> tuple[list, np.ndarray]:
    """Sample ids and the dense kinship matrix on the driver; more than `most` samples are an error (the model is cubic in them)."""
    ids = sorted(r[0] for r in pairs.select("sample_a").distinct().limit(most + 1).collect())
    if len(ids) > most:
        raise ValueError(f"more than {most} samples")
    at, k = {s: i for i, s in enumerate(ids)}, np.zeros((len(ids), len(ids)))
    for r in pairs.toLocalIterator():
        k[at[r.sample_a], at[r.sample_b]] = k[at[r.sample_b], at[r.sample_a]] = r.k
    return ids, k


def components(k: np.ndarray, n: int) -> np.ndarray:
    """Leading components, the entry of largest magnitude positive."""
    values, vectors = np.linalg.eigh(k)
    out = vectors[:, np.argsort(values)[::-1][:n]]
    return out * np.sign(out[np.abs(out).argmax(axis=0), np.arange(out.shape[1])])


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Covariates to mean 0 and population deviation 1."""
    stats = df.agg(*[f(c).alias(f"_{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    return df.crossJoin(stats).select(*[c for c in df.columns if c not in columns], *[((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")).alias(c) for c in columns])


def least_squares(z: DataFrame, y: DataFrame) -> DataFrame:
    """beta and se of each marker without relatedness, from sums by marker; `y`: sample_id and y."""
    by = z.join(y, "sample_id").groupBy("marker_id")
    s = by.agg(F.count("*").alias("n"), F.sum("z").alias("sz"), F.sum(F.col("z") ** 2).alias("szz"), F.sum(F.col("z") * F.col("y")).alias("szy"), F.sum("y").alias("sy"), F.sum(F.col("y") ** 2).alias("syy"))
    s = s.select("marker_id", "n", (F.col("szz") - F.col("sz") ** 2 / F.col("n")).alias("xx"), (F.col("szy") - F.col("sz") * F.col("sy") / F.col("n")).alias("xy"), (F.col("syy") - F.col("sy") ** 2 / F.col("n")).alias("yy"))
    beta = F.col("xy") / F.col("xx")
    return s.select("marker_id", beta.alias("beta"), F.sqrt((F.col("yy") - beta * F.col("xy")) / (F.col("n") - 2) / F.col("xx")).alias("se"))


@dataclass(frozen=True)
class NullModel:
    """Rotation, weights and covariate basis of a fitted model without any marker."""

    rotation: np.ndarray
    weights: np.ndarray
    basis: np.ndarray
    residual: np.ndarray
    delta: float
    df: int


def fit_null(y: np.ndarray, covariates: np.ndarray, k: np.ndarray) -> NullModel:
    """Restricted likelihood over log delta in [-12, 12], where the covariance is K + delta I."""
    values, rotation = np.linalg.eigh((k + k.T) / 2)
    values = np.maximum(values, 0)
    ry, rx = rotation.T @ y, rotation.T @ covariates
    n, q = covariates.shape

    def loss(log_delta: float) -> float:
        d = values + math.exp(log_delta)
        w = 1 / np.sqrt(d)
        basis, r = np.linalg.qr(rx * w[:, None])
        e = ry * w - basis @ (basis.T @ (ry * w))
        return (n - q) * math.log(max(float(e @ e), 1e-300)) + float(np.log(d).sum()) + 2 * float(np.log(np.abs(np.diag(r))).sum())

    grid = np.linspace(-12, 12, 49)
    best = min(range(len(grid)), key=lambda i: loss(grid[i]))
    log_delta = bounded_minimum(loss, grid[max(0, best - 1)], grid[min(len(grid) - 1, best + 1)])
    w = 1 / np.sqrt(values + math.exp(log_delta))
    basis = np.linalg.qr(rx * w[:, None])[0]
    wy = ry * w
    return NullModel(rotation, w, basis, wy - basis @ (basis.T @ wy), math.exp(log_delta), n - q - 1)


def test_markers(z: DataFrame, ids: list, model: NullModel) -> DataFrame:
    """beta, se and neg_log10_pvalue of each marker, or reason collinear. Markers' vectors, in the order of the sorted sample ids, go through a kernel in blocks that share one null model, bounded by the samples; p-values of a block are
    found together in log space."""
    vectors = z.groupBy("marker_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("sample_id", "z"))), lambda x: x["z"]).alias("v"))
    kind, n = dict(z.dtypes)["marker_id"], len(ids)

    def kernel(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            if any(len(v) != n for v in pdf["v"]):
                raise ValueError("a marker hasn't a value for each sample")
            g = model.rotation.T @ np.vstack(pdf["v"].to_numpy()).T * model.weights[:, None]
            norm = (g * g).sum(axis=0)
            g = g - model.basis @ (model.basis.T @ g)
            gg = (g * g).sum(axis=0)
            flat = gg <= 1e-10 * np.maximum(norm, 1e-300)
            gg = np.where(flat, 1.0, gg)
            beta = (g * model.residual[:, None]).sum(axis=0) / gg
            rest = model.residual[:, None] - g * beta
            se = np.sqrt((rest * rest).sum(axis=0) / model.df / gg)
            t = np.divide(beta, se, out=np.full(len(se), np.inf), where=se > 0)
            nlp = -(log_t_sf(t, model.df) + math.log(2)) / math.log(10)
            yield pd.DataFrame({"marker_id": pdf["marker_id"], "beta": np.where(flat, np.nan, beta), "se": np.where(flat, np.nan, se), "neg_log10_pvalue": np.where(flat, np.nan, nlp), "reason": np.where(flat, "collinear", "")})

    return vectors.mapInPandas(kernel, f"marker_id {kind}, beta double, se double, neg_log10_pvalue double, reason string")


def aligned(wide: DataFrame, markers: list[str], variants: DataFrame, phenotypes: DataFrame, samples: DataFrame, **declared: str) -> None:
    """Nothing is joined before both sides are known to be the same: the markers of a wide genotype table's header and the variant table's, the samples of all tables, one marker for each variant, and the declared trait, unit,
    cohort and assembly in every row. `wide`: sample_id and the markers; `variants`: marker_id, chr, pos, ref, alt, assembly_id; `phenotypes`: sample_id, trait, unit; `samples`: sample_id, cohort_id.
    """
    if len(set(markers)) != len(markers):
        raise ContractError(f"repeated markers in the header: {sorted({m for m in markers if markers.count(m) > 1})[:5]}")
    header = wide.sparkSession.createDataFrame([(m,) for m in markers], "marker_id string")
    if odd := set_differences(header, variants, ["marker_id"]).limit(5).collect():
        raise ContractError(f"markers of the header only (left) or of the variant table only (right): {[(r.marker_id, r.side) for r in odd]}")
    for name, rows, key in (("marker", variants, ["marker_id"]), ("variant", variants, ["chr", "pos", "ref", "alt"]), ("sample of the genotypes", wide, ["sample_id"]), ("sample of the phenotypes", phenotypes, ["sample_id"]), ("sample of the sample table", samples, ["sample_id"])):
        if twice := rows.groupBy(*key).count().where("count > 1").limit(1).collect():
            raise DuplicateError(f"{name} {':'.join(str(twice[0][k]) for k in key)} is there more than once")
    single = F.col("ref").rlike("^[ACGT]$") & F.col("alt").rlike("^[ACGT]$") & (F.col("ref") != F.col("alt"))
    if odd := variants.where(~F.coalesce(single, F.lit(False))).limit(1).collect():
        raise ContractError(f"{odd[0].marker_id}: REF and ALT must be two different bases")
    ids_aligned({"genotypes": wide, "phenotypes": phenotypes, "samples": samples})
    for rows, column in ((phenotypes, "trait"), (phenotypes, "unit"), (samples, "cohort_id"), (variants, "assembly_id")):
        if column in declared and (odd := rows.where(~F.col(column).eqNullSafe(F.lit(declared[column]))).limit(1).collect()):
            raise ContractError(f"{column} is {odd[0][column]!r}, not {declared[column]!r}")


def ids_aligned(parts: dict[str, DataFrame]) -> None:
    """Set equality of the sample ids of all tables; never a silent inner join."""
    names = list(parts)
    counts = parts[names[0]].select("sample_id").distinct().withColumn("n", F.lit(1))
    for n in names[1:]:
        counts = counts.unionByName(parts[n].select("sample_id").distinct().withColumn("n", F.lit(1)))
    odd = counts.groupBy("sample_id").agg(F.sum("n").alias("n")).where(F.col("n") < len(names)).limit(1).collect()
    if odd:
        raise ContractError(f"sample {odd[0].sample_id!r} isn't in all of {names}")
