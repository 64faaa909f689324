import random

from pairforge.operators.scan import running
from pairforge.operators.training_log import early_stop, top_checkpoints

VALS = [0.1, 0.3, 0.2, 0.3, 0.4]


def _log(spark, rows):
    return spark.createDataFrame(rows, "run_id long, epoch long, step long, name string, value double, weight long")


def test_early_stop_literal(spark):
    log = _log(spark, [(1, 0, i + 1, "val_bleu", v, 1) for i, v in enumerate(VALS)])
    r = early_stop(log, "val_bleu", 2).first()
    assert (r.stop_check, r.stop_step) == (4, 4)


def test_top_checkpoints_literal(spark):
    log = _log(spark, [(1, 0, i + 1, "val_bleu", v, 1) for i, v in enumerate(VALS)])
    r = {x.step: (x.rank, x.is_last) for x in top_checkpoints(log, "val_bleu", 3).collect()}
    assert r == {5: (1, True), 2: (2, False), 4: (3, False)}


def test_blocked_running_max_on_hot_group(spark):
    rnd = random.Random(0)
    rows = [(0 if i % 3 else rnd.randint(1, 4), i, rnd.random()) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, step long, v double")
    got = {(r.g, r.step): r.m for r in running(df, ["g"], "step", "v", "m", "max", depth=64).collect()}
    best = {}
    for g, s, v in sorted(rows, key=lambda x: x[1]):
        assert got[(g, s)] == best.get(g)
        best[g] = max(best.get(g, v), v)
