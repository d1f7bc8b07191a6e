"""The streaming standings equal the batch standings over the same battles."""

import os
import tempfile

from ledgerplay.operators import gamelog as GL
from ledgerplay.plans import bindings as B
from ledgerplay.streaming import standings_stream
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    b = B.battles(spark, SF_SMALL)
    src = tempfile.mkdtemp(prefix="ledgerplay-stream-src-")
    b.where("battle_id % 2 = 0").write.mode("append").parquet(src)
    b.where("battle_id % 2 = 1").write.mode("append").parquet(src)
    q = standings_stream(spark, src, b.schema, "standings_test")
    q.awaitTermination(120)
    got = {r.player_name: (r.battle_count, r.won, r.points) for r in spark.sql("SELECT * FROM standings_test").collect()}
    want = {r.player_name: (r.battle_count, r.won, r.points) for r in GL.standings(GL.battle_sides(b)).collect()}
    assert got == want
    assert os.path.isdir(src)
