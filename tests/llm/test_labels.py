"""Labels beyond a centre's are kept rarest first, so that few items meet over a common passage."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from twinledger.llm import links
from twinledger.llm.neardup import LINK


def test_common_labels_are_left_out_first(spark):
    rng = np.random.default_rng(3)
    draw = lambda n: rng.integers(1, 1 << 62, n).astype(np.uint64)
    centre, passage = draw(40), draw(30)
    items = [np.concatenate([centre[:10], passage, draw(30)]) for _ in range(60)]
    known = spark.createDataFrame([(i, bytearray(x.tobytes())) for i, x in enumerate(items)], "id long, labels binary")
    counts = links.label_counts(known.repartition(7), LINK)
    assert counts.sum() == sum(map(len, items))
    assert (counts[links.counters(passage)] >= len(items)).all()
    batch = pa.record_batch(
        {
            **{name: pa.array(range(len(items)), pa.int64()) for name in ("b", "id", "root", "main")},
            "left": pa.array([centre.tobytes()] * len(items), pa.binary()),
            "right": pa.array([x.tobytes() for x in items], pa.binary()),
        }
    )
    (found,) = LINK.differences(iter([batch]), counts)
    for item, fresh in zip(items, found.column("fresh").to_pylist()):
        fresh = np.array(fresh, dtype=np.int64).view(np.uint64)
        # 60 of 70 labels are new, a partner shares 46 of them at least: 15 tell of each one.
        assert len(fresh) == 15 and np.isin(fresh, item[40:]).all()
