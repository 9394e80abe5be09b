"""V3 over more than two classes against counted pairs."""

import numpy as np

from tessera.operators import metrics as M


def pairs_auc(score, positive):
    up, down = score[positive], score[~positive]
    return ((up[:, None] > down).sum() + 0.5 * (up[:, None] == down).sum()) / (len(up) * len(down))


def test_each_class_against_the_rest(spark):
    rng = np.random.default_rng(2)
    n = 400
    y = rng.choice(["a", "b", "c"], n, p=[0.6, 0.3, 0.1])
    s = {c: np.round((y == c) * 0.3 + rng.random(n), 1) for c in "abc"}     # one digit: many ties
    rows = [(str(l), *(float(s[c][i]) for c in "abc"), 0.5) for i, l in enumerate(y)] + [(None, 0.1, 0.2, 0.3, 0.4)]
    df = spark.createDataFrame(rows, "label string, sa double, sb double, sc double, sd double").repartition(4)
    per = M.roc_auc_ovr(df, list("abcd"), ["sa", "sb", "sc", "sd"], digits=9)
    got = {r["class"]: (r.support, r.roc_auc) for r in per.collect()}
    want = {c: pairs_auc(s[c], y == c) for c in "abc"}
    assert got["d"] == (0, None)                                            # no row has it
    for c, auc in want.items():
        assert got[c][0] == (y == c).sum() and abs(got[c][1] - auc) < 1e-8
    mean = M.roc_auc_average(per, digits=9).first()
    assert abs(mean.macro_auc - np.mean(list(want.values()))) < 1e-8
    assert abs(mean.weighted_auc - sum((y == c).mean() * a for c, a in want.items())) < 1e-8


def test_two_classes_equal_the_binary_form(spark):
    df = spark.createDataFrame([(1, 0.9, 0.1), (0, 0.4, 0.6), (1, 0.4, 0.6), (0, 0.2, 0.8)], "label int, score double, other double")
    got = {r["class"]: r.roc_auc for r in M.roc_auc_ovr(df, [1, 0], ["score", "other"]).collect()}
    assert got[1] == got[0] == M.roc_auc(df).first().roc_auc == 0.875
