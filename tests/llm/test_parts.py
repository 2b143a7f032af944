"""Parts get equal numbers where their bytes are equal, and only there."""

import random

import numpy as np
import pytest

from clicktrail.llm.parts import HEAD, PLACES, Parts


def spans(rng, data):
    """Ranges of `data` in any order, also over each other, with repeats of the same bytes elsewhere."""
    sizes = [1, 2, 7, 8, 9, HEAD - 1, HEAD, HEAD + 1, PLACES, PLACES + HEAD + 1, 300]
    found = [(start, start + rng.choice(sizes)) for start in rng.choices(range(len(data) - 300), k=2000)]
    return np.array(found + [(len(data) - size, len(data)) for size in sizes], np.int64)


@pytest.mark.parametrize("clashing", [False, True])
def test_numbers_tell_parts_apart(clashing):
    rng = random.Random(3)
    parts = Parts()
    if clashing:
        # All short parts have one hash, and long ones that of few others.
        parts.factors[:] = 0
        parts.values[:] = 1
    seen = {}
    for _ in range(3):
        data = np.array(rng.choices([0, 97, 98, 255], [1, 60, 1, 1], k=5000), np.uint8)
        at = spans(rng, data)
        for (start, end), number in zip(at.tolist(), parts.number(data, at[:, 0], at[:, 1]).tolist(), strict=True):
            part = data[start:end].tobytes()
            assert seen.setdefault(part, number) == number
            assert parts.part(number) == part
    assert len(set(seen.values())) == len(seen) <= len(parts)
    parts.forget()
    assert len(parts) == 0 and not len(parts.number(data, at[:0, 0], at[:0, 1]))
