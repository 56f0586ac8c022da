"""What Python steps hold: batches bounded by bytes, and nothing that was freed."""

import subprocess
import sys
from pathlib import Path

import pyarrow as pa

from searchloom.storage import BATCH, BATCH_BYTES, written

HELD = """
import pyarrow as pa
import searchloom.llm
def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 / 1e6
x = bytearray(16 << 20); del x
before = held()
blocks = [bytearray(b"x") * (6 << 20) for _ in range(20)]
above = bytearray(b"y") * 100_000
del blocks
print(held() - before, pa.default_memory_pool().backend_name)
"""


def test_freed_blocks_go_back_to_the_system():
    repo = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", HELD], cwd=repo, capture_output=True, text=True, check=True)
    megabytes, pool = done.stdout.split()
    assert float(megabytes) < 40 and pool == "system"


def test_written_tables_are_made_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], ["n"])

    before = spark.conf.get(BATCH)
    texts = spark.range(0, 3000, 1, 1).selectExpr("repeat('x', 10000) AS text")
    rows = [r.n for r in written(texts.mapInArrow(sizes, "n long"), "sizes").collect()]
    assert sum(rows) == 3000 and max(rows) <= BATCH_BYTES // 10000 + 1
    assert spark.conf.get(BATCH) == before
