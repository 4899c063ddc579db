"""Workers of near-duplicate detection hand their memory back when a task ends, however little they hold."""

import numpy as np
import pyarrow as pa
import pytest

from stationlake.llm import near_dup as ND
from stationlake.llm import textvec as tv

SET = np.arange(5, dtype=np.uint64).tobytes()


def batch(**columns):
    return iter([pa.RecordBatch.from_pydict(columns)])


@pytest.mark.parametrize("run, rows", [
    (ND._sketcher(3, 64, pa.int64()), {"id": [1], "rk": [2], "text": ["a b c d"]}),
    (ND._set_writer(3), {"cid": [1], "k1": [0], "k2": [0], "text": ["a b c d"]}),
    (ND._verifier(64, 85, 100), {"a": [1], "b": [2], "sa": [SET], "sb": [SET]}),
    (ND._differ, {"head": [1], "cid": [2], "n": [5], "label": [1], "sa": [SET], "sb": [SET[:16]]}),
])
def test_a_task_leaves_no_memory_with_its_worker(monkeypatch, run, rows):
    freed = []
    monkeypatch.setattr(tv, "lean", lambda above=tv.LEAN_BYTES: freed.append(above))
    assert len(list(run(batch(**rows)))) == 1
    assert freed[-1] == 0
