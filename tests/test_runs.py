"""Run comparison operators on small score tables (no kernels involved)."""

import pytest

from colloquy.operators import runs as R

ROWS = [("a", "1", 0, 0.5), ("a", "1", 1, 0.7), ("a", "2", 0, 0.1), ("a", "2", 1, 0.3),
        ("a", "3", 0, 0.9),                      # transcript 3 lacks segment 1
        ("b", "1", 0, 1.0), ("b", "1", 1, float("nan"))]


@pytest.fixture()
def scores(spark):
    return spark.createDataFrame(ROWS, "run_name string, id string, segment int, lev_acc double")


def test_progression_means_and_completeness(scores):
    rows = {(r.run_name, r.id, r.segment): r for r in R.progression(scores, "lev_acc").collect()}
    assert rows[("a", "1", 0)].mean_value == pytest.approx((0.5 + 0.1 + 0.9) / 3)
    assert rows[("a", "2", 1)].mean_value == pytest.approx((0.7 + 0.3) / 2)
    assert rows[("a", "1", 0)].complete and not rows[("a", "3", 0)].complete


def test_run_means_skip_nan(scores):
    means = {r.run_name: r for r in R.run_means(scores).collect()}
    assert means["b"].lev_acc == 1.0 and means["b"].n_rows == 2
    assert means["a"].lev_acc == pytest.approx((0.5 + 0.7 + 0.1 + 0.3 + 0.9) / 5)


def test_compare_runs_keeps_order_and_repeats(spark, scores):
    means = R.run_means(scores)
    sel = R.selection_frame(spark, [("b", "second"), ("a", "first"), ("b", "again"), ("zz", "absent")])
    got = [(r.ord, r.run_name, r.label) for r in R.compare_runs(means, sel).collect()]
    assert got == [(0, "b", "second"), (1, "a", "first"), (2, "b", "again")]
    assert [r.run_name for r in R.missing_runs(means, sel).collect()] == ["zz"]


def test_compare_groups_mean_of_means(spark, scores):
    means = R.run_means(scores)
    groups = R.selection_frame(spark, [("a", "g"), ("b", "g")])
    row = R.compare_groups(means, groups).first()
    assert row.n_runs == 2
    assert row.lev_acc == pytest.approx(((0.5 + 0.7 + 0.1 + 0.3 + 0.9) / 5 + 1.0) / 2)


def test_segment_means_count_segments(scores):
    rows = {(r.run_name, r.segment): r for r in R.segment_means(scores).collect()}
    assert rows[("a", 0)].n_segments == 2 and rows[("a", 0)].n_rows == 3


def test_catalogue_in_one_pass_equals_the_named_comparisons(spark):
    from colloquy.operators import runs as R
    names = {r for named in (R.CATALOGUE, R.GROUP_CATALOGUE) for rows in named.values() for r, _ in rows}
    scores = spark.createDataFrame([(n, f"t{i}", 0, (k * 7 + i) / 500) for k, n in enumerate(sorted(names)[1:]) for i in range(2)],
                                   "run_name string, id string, segment int, lev_acc double")
    means = R.run_means(scores)
    got = R.compare_catalogue(means).collect()
    for name in [*R.CATALOGUE, *R.GROUP_CATALOGUE]:
        want = R.compare_named(means, name).collect()
        mine = sorted((r for r in got if r.selection == name), key=lambda r: r.ord)
        assert [(r.ord, r.label, round(r.lev_acc, 9)) for r in mine] == [(r.ord, r.label, round(r.lev_acc, 9)) for r in want]
