"""Numbers that stay when rows come later."""

import random

from stratalake.operators import ledger

SCHEMA = "k string, t int, id int"


def test_batches_against_a_plain_count(spark, tmp_path):
    random.seed(1)
    rows = [(random.choice(["a", "b", None]), random.choice([None, 1, 2, 3]), i) for i in range(60)]
    have, seen = {}, set()
    for batch, part in enumerate((rows[:20], rows[10:45], [], rows[:60])):
        new = [r for r in part if r[2] not in seen]
        for k in {r[0] for r in new}:
            at = sum(1 for r in have if r[0] == k)
            mine = sorted((r for r in new if r[0] == k), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
            have |= {r: at + i for i, r in enumerate(mine)}
        seen |= {r[2] for r in new}
        got = ledger.append_numbered(spark.createDataFrame(part, SCHEMA), f"{tmp_path}/l", batch, ["k"], ["t", "id"], ["id"], block_rows=7 if batch % 2 else None)
        assert {(r.k, r.t, r.id) for r in got.collect()} == set(new)
        assert {(r.k, r.t, r.id): r.seq for r in ledger.numbered(spark, f"{tmp_path}/l").collect()} == have


def test_a_batch_is_made_once_and_repaired_if_it_was_cut_off(spark, tmp_path):
    path, df = f"{tmp_path}/l", spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], SCHEMA)
    assert ledger.numbered(spark, path) is None
    df.withColumnRenamed("id", "seq").write.parquet(f"{path}/rows/batch=0")  # rows of a run that ended before its ledger
    for _ in range(2):
        got = ledger.append_numbered(df, path, 0, ["k"], ["t"])
        assert sorted((r.id, r.seq) for r in got.collect()) == [(1, 0), (2, 1)]
    more = ledger.append_numbered(df, path, 1, ["k"], ["t"])
    assert sorted((r.id, r.seq) for r in more.collect()) == [(1, 2), (2, 3)]
    assert ledger.numbered(spark, path).count() == 4
