"""What the operators share."""

import re
import subprocess
import sys

import pyarrow as pa
import pytest

from stratafold.llm.rows import slices

HELD = """
import re
from stratafold.llm.rows import slices

def resident():
    return int(re.search(r"\\nPss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1])

before = resident()
held = [bytes(1024) + bytes([i % 256]) for i in range(100_000)]
last = bytes(2048)
del held
freed = resident() - before
list(slices([]))
print(freed, resident() - before)
"""


def test_slices_keep_rows_and_order():
    batches = [pa.record_batch([pa.array(range(n))], ["a"]) for n in (0, 3, 5)]
    assert [s.column(0).to_pylist() for s in slices(batches, 2)] == [[0, 1], [2], [0, 1], [2, 3], [4]]


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_a_task_gives_freed_memory_back():
    kept, rest = map(int, re.findall(r"-?\d+", subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True).stdout))
    assert kept > 50_000
    assert rest < 25_000
