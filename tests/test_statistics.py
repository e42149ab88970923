"""Association, variance analysis, normality and plot tables against brute force."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketlens import config
import scalar_tails as tails
from basketlens.functions import normal
from basketlens.operators import anova, association, correlation, describe, normality, plotdata, skew


def pairs_frame(spark, table):
    """Rows that give the table {(a, b): n}."""
    rows = [(a, b) for (a, b), n in table.items() for _ in range(n)]
    return spark.createDataFrame([*rows, (None, "x"), ("p", None)], "a STRING, b STRING").repartition(3)


def chi2(spark, table):
    return association.with_chi_square_p(association.chi_square(pairs_frame(spark, table), [("a", "b")])).first()


def test_chi_square_with_an_empty_cell(spark):
    found = chi2(spark, {("p", "x"): 10, ("p", "y"): 20, ("p", "z"): 5, ("q", "x"): 12, ("q", "z"): 8})
    observed = np.array([[10, 20, 5], [12, 0, 8]], dtype=float)
    expected = np.outer(observed.sum(1), observed.sum(0)) / observed.sum()
    value = ((observed - expected) ** 2 / expected).sum()
    assert (found["chi2"], found["dof"], found["n"]) == (pytest.approx(value), 2, 55)
    assert found["cramers_v"] == pytest.approx(math.sqrt(value / 55))
    assert found["pvalue"] == pytest.approx(math.exp(-value / 2))  # two degrees of freedom


@pytest.mark.parametrize("cells", [(12, 5, 7, 30), (1, 1, 1, 1), (9, 0, 4, 3)])
def test_two_by_two_is_corrected(spark, cells):
    table = {k: n for k, n in zip([("p", "x"), ("p", "y"), ("q", "x"), ("q", "y")], cells) if n}
    observed = np.array(cells, dtype=float).reshape(2, 2)
    expected = np.outer(observed.sum(1), observed.sum(0)) / observed.sum()
    gap = np.abs(observed - expected)
    value = ((gap - np.minimum(0.5, gap)) ** 2 / expected).sum()
    found = chi2(spark, table)
    assert (found["chi2"], found["dof"]) == (pytest.approx(value), 1)
    assert 0 <= found["cramers_v"] <= 1


def test_one_level_has_no_association(spark):
    found = chi2(spark, {("p", "x"): 10, ("p", "y"): 20})
    assert (found["chi2"], found["dof"], found["cramers_v"], found["pvalue"]) == (0.0, 0, None, 1.0)


@pytest.fixture(scope="module")
def groups(spark):
    draw = np.random.default_rng(5)
    rows = [(g, float(x)) for g, mean, n in (("a", 10, 40), ("b", 11, 25), ("c", 14, 60)) for x in draw.normal(mean, 2, n)]
    rows += [("a", None), (None, 5.0)]
    return rows, spark.createDataFrame(rows, "channel STRING, amount DOUBLE").repartition(3)


def test_anova_and_tukey(groups):
    rows, df = groups
    data = {g: np.array([x for h, x in rows if h == g and x is not None]) for g in "abc"}
    every = np.concatenate(list(data.values()))
    within = sum(((x - x.mean()) ** 2).sum() for x in data.values()) / (len(every) - 3)
    between = sum(len(x) * (x.mean() - every.mean()) ** 2 for x in data.values()) / 2
    found = anova.with_anova_p(anova.anova(df)).first()
    assert (found["factor"], found["n_groups"], found["n"]) == ("channel", 3, 125)
    assert found["f_stat"] == pytest.approx(between / within)
    assert found["pvalue"] == pytest.approx(tails.f_sf(between / within, 2, 122))
    rows = {(r["group1"], r["group2"]): r for r in anova.tukey(df).collect()}
    assert set(rows) == {("a", "b"), ("a", "c"), ("b", "c")}
    for (g, h), r in rows.items():
        assert r["meandiff"] == pytest.approx(data[h].mean() - data[g].mean())
        assert r["lower"] < r["meandiff"] < r["upper"]
        # The interval excludes zero exactly when the difference is significant.
        assert r["reject"] == (r["lower"] > 0 or r["upper"] < 0) == (r["p_adj"] < 0.05)


def test_single_group_has_no_f(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "channel STRING, amount DOUBLE")
    assert anova.anova(df).first()["f_stat"] is None
    assert anova.tukey(df).count() == 0


def test_numeric_levels_are_ordered_as_numbers(spark):
    df = spark.createDataFrame([(s, float(s + i)) for s in (2, 10) for i in range(5)],
                               "store INT, amount DOUBLE")
    r = anova.pairwise(df).first()
    assert (r["group1"], r["group2"], r["meandiff"]) == ("2", "10", 8.0)


def test_pearson(spark):
    draw = np.random.default_rng(2)
    x = draw.normal(size=200)
    y = x + draw.normal(size=200)
    df = spark.createDataFrame([(float(a), None if i < 20 else float(b), 1.0) for i, (a, b) in enumerate(zip(x, y))],
                               "x DOUBLE, y DOUBLE, c DOUBLE")
    found = {(r["var1"], r["var2"]): r for r in correlation.with_correlation_p(
        correlation.pearson_pairs(df, [("x", "y"), ("x", "c"), ("x", "x")])).collect()}
    assert found["x", "y"]["corr"] == pytest.approx(np.corrcoef(x[20:], y[20:])[0, 1])
    assert (found["x", "y"]["n"], found["x", "x"]["corr"]) == (180, pytest.approx(1.0))
    assert (found["x", "c"]["corr"], found["x", "c"]["pvalue"]) == (None, None)
    matrix = {(r["var1"], r["var2"]): r["corr"] for r in correlation.correlation_matrix(df, ["x", "y"]).collect()}
    assert len(matrix) == 4 and matrix["x", "y"] == matrix["y", "x"]


def test_method_follows_normality(spark):
    draw = np.random.default_rng(8)
    rows = [tuple(map(float, r)) for r in zip(draw.normal(size=400), draw.normal(size=400), draw.exponential(size=400))]
    df = spark.createDataFrame(rows, "x DOUBLE, y DOUBLE, e DOUBLE").repartition(3)
    found = {(r["var1"], r["var2"]): r["method"] for r in correlation.correlations(df).collect()}
    assert (found["x", "y"], found["x", "e"]) == ("pearson", "spearman")
    judged = {r["variable"]: r["verdict"] for r in normality.verdict(
        normality.normality_table(df, ["x", "e"])).collect()}
    assert judged == {"x": config.NORMAL_NOT_REJECTED, "e": config.NORMAL_REJECTED}
    lines = normality.verdict_lines(normality.verdict(normality.normality_table(df, ["x"]))).first()["line"]
    assert lines.startswith("x: shapiro_p=") and lines.endswith("-> " + config.NORMAL_NOT_REJECTED)


def test_normality_blocks_are_bounded_and_complete(spark):
    df = spark.range(12_345).select(F.randn(1).alias("x"), F.when(F.col("id") % 3 == 0, 1.0).alias("k")).repartition(3)
    blocks = normality.normality_blocks(df, ["x", "k"], 1000).collect()
    assert max(r["n"] for r in blocks) == 1000
    assert sum(r["n"] for r in blocks if r["variable"] == "x") == 12_345
    assert sum(r["n"] for r in blocks if r["variable"] == "k") == 4115
    assert {r["ks_stat"] for r in blocks if r["variable"] == "k"} == {None}


def test_normality_does_not_depend_on_the_layout(spark):
    values = [(float(v), float(v % 7)) for v in np.random.default_rng(9).integers(0, 5000, 7000)]
    df = spark.createDataFrame(values, "x DOUBLE, k DOUBLE")
    found = [sorted(map(tuple, normality.normality_blocks(df.repartition(n), ["x", "k"], 1000).collect())) for n in (1, 4, 8)]
    assert found[0] == found[1] == found[2] and len(found[0]) == 14


def test_normal_arithmetic(spark):
    z = [-40.0, -8.0, -7.0, -3.3, -0.5, 0.0, 1e-9, 2.0, 6.9, 7.2, 40.0]
    p = [1e-12, 1e-7, 0.01, 0.074, 0.08, 0.5, 0.9, 0.926, 1 - 1e-9]
    df = spark.createDataFrame([(x,) for x in z], "z DOUBLE").select("z", normal.normal_cdf("z").alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(0.5 * math.erfc(-r["z"] / math.sqrt(2)), rel=1e-7, abs=1e-300)
    df = spark.createDataFrame([(x,) for x in p], "p DOUBLE").select("p", normal.normal_quantile("p").alias("z"))
    for r in df.collect():
        assert r["z"] == pytest.approx(tails.NORMAL.inv_cdf(r["p"]), rel=1e-13, abs=1e-15)
    odd = spark.createDataFrame([(0.0,), (1.0,), (None,)], "p DOUBLE").select(normal.normal_quantile("p").alias("z"))
    assert {r["z"] for r in odd.collect()} == {None}


def test_ks_on_full_data(spark):
    values = [float(v) for v in np.random.default_rng(4).integers(0, 30, 500)]
    df = spark.createDataFrame([(v,) for v in values], "x DOUBLE").repartition(3)
    x = np.sort(values)
    cdf = normal.normal_cdf_array((x - x.mean()) / x.std())
    d = max((np.arange(1, 501) / 500 - cdf).max(), (cdf - np.arange(500) / 500).max())
    assert normality.ks_normal(df, ["x"]).first()["ks_stat"] == pytest.approx(d)


@pytest.fixture(scope="module")
def skewed(spark):
    values = [float(v) for v in np.random.default_rng(6).exponential(10, 900)] + [5.0] * 450
    return np.array(values), spark.createDataFrame([(v, "g" if i % 2 else "h") for i, v in enumerate(values)],
                                                   "amount DOUBLE, channel STRING").repartition(4)


def test_histogram(spark, skewed):
    values, df = skewed
    rows = plotdata.histogram(df, ["amount"]).orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(np.histogram(values, 30)[0])
    constant = plotdata.histogram(spark.createDataFrame([(2.0,)] * 3, "x DOUBLE"), ["x"], 10).collect()
    assert sum(r["n"] for r in constant) == 3 and len(constant) == 10


def test_density(skewed):
    values, df = skewed
    rows = plotdata.density(df, ["amount"], 50).orderBy("point").collect()
    h = values.std(ddof=1) * len(values) ** -0.2
    for r in rows[::7]:
        z = (r["x"] - values) / h
        assert r["density"] == pytest.approx(np.exp(-z * z / 2).sum() / (len(values) * h * math.sqrt(2 * math.pi)))


@pytest.mark.parametrize("chunk", [7, 1000])
def test_qq_fit(skewed, chunk):
    values, df = skewed
    q = [tails.NORMAL.inv_cdf(p) for p in tails.filliben(np.arange(1, len(values) + 1), len(values))]
    slope, intercept = np.polyfit(q, np.sort(values), 1)
    found = plotdata.qq_fit(df, ["amount"], chunk).first()
    assert (found["slope"], found["intercept"]) == (pytest.approx(slope), pytest.approx(intercept))
    assert found["r"] == pytest.approx(np.corrcoef(q, np.sort(values))[0, 1])


def test_qq_fit_of_hot_and_single_values(spark, monkeypatch):
    """Runs longer than a chunk, runs of a few and single values, summed in small arrays in the tasks; an empty column has no fit."""
    values = np.array([5.0] * 500 + [float(i % 40) for i in range(200)] + [i / 7 for i in range(300)])
    df = spark.createDataFrame([(float(x), float(-x) if i % 3 else None, None) for i, x in enumerate(values)], "amount DOUBLE, units DOUBLE, none DOUBLE")

    fit = plotdata.qq_fit(df, ["amount", "units", "none"], 100)
    assert "MapInArrow" in fit._jdf.queryExecution().executedPlan().toString()
    found = {r["variable"]: r for r in fit.collect()}
    assert set(found) == {"amount", "units"}
    for name, x in (("amount", values), ("units", np.array([-v for i, v in enumerate(values) if i % 3]))):
        q = [tails.NORMAL.inv_cdf(p) for p in tails.filliben(np.arange(1, len(x) + 1), len(x))]
        slope, intercept = np.polyfit(q, np.sort(x), 1)
        assert found[name]["n"] == len(x) and (found[name]["slope"], found[name]["intercept"]) == (pytest.approx(slope), pytest.approx(intercept))
    batch = pa.RecordBatch.from_pydict({"variable": ["x", "x", "x"], "value": [1.0, 2.0, 4.0], "a": [1, 11, 151], "b": [10, 150, 200], "n": [200] * 3, "centre": [2.0] * 3})
    whole = next(plotdata._position_sums([batch])).to_pylist()
    monkeypatch.setattr(plotdata, "RANKS_AT_ONCE", 16)
    parts = next(plotdata._position_sums([batch])).to_pylist()
    assert parts[0] == pytest.approx(whole[0]) and whole[0]["sv"] == pytest.approx(-10 + 2 * 50)


def test_boxes(skewed):
    values, df = skewed
    for r in plotdata.box_stats(df, [("amount", "channel")]).collect():
        x = values[(1 if r["level"] == "g" else 0)::2]
        q1, q3 = np.quantile(x, [0.25, 0.75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        assert (r["n"], r["outliers"]) == (len(x), len(x) - len(inside))
        assert [r["whisker_low"], r["q1"], r["q3"], r["whisker_high"]] == pytest.approx([inside.min(), q1, q3, inside.max()])


def test_scatter_bins_and_regression(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1) for i in range(100)] + [(1.0, None)], "x DOUBLE, y DOUBLE")
    assert plotdata.scatter_bins(df, "x", "y", 10).agg(F.sum("n")).first()[0] == 100
    line = correlation.regression_lines(df, [("x", "y")])
    assert (line.first()["slope"], line.first()["intercept"]) == (pytest.approx(2.0), pytest.approx(1.0))
    points = plotdata.line_points(line).orderBy("point").collect()
    assert (len(points), points[0]["y"], points[-1]["y"]) == (100, pytest.approx(1.0), pytest.approx(199.0))


def test_full_statistics(spark):
    df = spark.createDataFrame([(float(v), 1.0, None) for v in (1, 2, 2, 3, 10)], "x DOUBLE, c DOUBLE, e DOUBLE")
    found = {r["variable"]: r for r in describe.full_statistics(df, ["x", "c", "e"]).collect()}
    assert (found["x"]["median"], found["x"]["mode"], found["x"]["range"], found["x"]["iqr"]) == (2.0, 2.0, 9.0, 1.0)
    assert found["x"]["variation"] == pytest.approx(np.std([1, 2, 2, 3, 10], ddof=1) / 3.6)
    assert (found["c"]["std"], found["c"]["skewness"], found["c"]["kurtosis"]) == (0.0, None, None)
    assert (found["e"]["mean"], found["e"]["median"], found["e"]["mode"]) == (None, None, None)
    counts = describe.describe(df, ["x", "e"]).collect()
    assert {r["variable"]: r["n"] for r in counts} == {"x": 5, "e": 0}


def test_frequencies_keep_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "channel STRING")
    assert [(r["value"], r["n"]) for r in describe.frequencies(df, ["channel"]).collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert [r["value"] for r in describe.top_frequencies(df, "channel", 1).collect()] == ["a"]


def test_sorts_take_more_tasks_for_more_rows(spark, monkeypatch):
    """What a task sorts is bounded by its rows, for the numbering and for the blocks' windows, and changes no result."""
    df = spark.range(600).select(F.pmod(F.col("id") * 7, F.lit(600)).alias("a"), F.pmod(F.col("id") * 11, F.lit(13)).alias("b"))

    def run():
        blocked = skew.with_blocks(df, ["a", "b"], 100)
        found = correlation.correlation_by_block(blocked, [("a", "b")])
        return sorted(blocked.collect()), found.collect(), blocked.rdd.getNumPartitions()

    few = run()
    monkeypatch.setattr(skew, "SORTED_ROWS", 50)
    many = run()
    assert many[0] == few[0] and many[2] == 12 > few[2]
    assert tuple(many[1][0][:2]) == ("a", "b") and many[1][0]["spearman"] == pytest.approx(few[1][0]["spearman"])


@pytest.mark.parametrize("few", [0, 6, 1000])
def test_spearman_is_the_same_whichever_columns_have_many_values(spark, monkeypatch, few):
    import random

    draw = random.Random(5)
    rows = [(draw.choice([None, 1.0, 2.0, 3.0, 3.0]), draw.choice([None, draw.random()]), draw.choice([0.0, float(draw.randrange(40))]),
             draw.random(), 4.0) for _ in range(300)]
    frame = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE, e DOUBLE").repartition(3)

    def ranks(values):
        return [sum(y < x for y in values) + (sum(y == x for y in values) + 1) / 2 for x in values]

    def expected(i, j):
        both = [r for r in rows if r[i] is not None and r[j] is not None]
        x, y = (ranks([r[k] for r in both]) for k in (i, j))
        mean = (len(both) + 1) / 2
        xy, xx, yy = (sum((p - mean) * (q - mean) for p, q in zip(u, v)) for u, v in ((x, y), (x, x), (y, y)))
        return xy / (xx * yy) ** 0.5 if xx and yy else None, len(both)

    monkeypatch.setattr(correlation, "LOOKUP_VALUES", few)
    pairs = [("a", "b"), ("d", "b"), ("c", "d"), ("b", "c"), ("d", "d"), ("a", "e"), ("c", "a")]
    found = {(r["var1"], r["var2"]): (r["corr"], r["n"]) for r in correlation.spearman_pairs(frame, pairs).collect()}
    for a, b in pairs:
        corr, n = expected("abcde".index(a), "abcde".index(b))
        assert found[a, b][1] == n
        assert found[a, b][0] is None if corr is None else abs(found[a, b][0] - corr) < 1e-12


def test_sums_of_a_sample_need_no_window():
    import numpy as np

    n, scored, squares, spread, ends, beside, d = normality._sums_of(np.array([3.0, 1.0, 2.0, 2.0]))
    assert (n, spread, ends, beside) == (4.0, 2.0, 2.0, 0.0) and 0 < scored < squares and 0 < d < 1
    assert normality._sums_of(np.array([0.1] * 7))[4:] == (0.0, 0.0, None)
    assert normality._sums_of(np.array([5.0]))[4:] == (0.0, None, None)
