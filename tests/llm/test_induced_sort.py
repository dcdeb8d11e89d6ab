import numpy as np
import pytest

from tests.llm.induced_sort import suffix_array


@pytest.mark.parametrize("seed", range(12))
def test_against_plain_sorting(tmp_path, seed):
    rng = np.random.default_rng(seed)
    text = bytes(rng.choice(list(b"abc"[: 1 + seed % 3]), int(rng.integers(1, 400))).astype(np.uint8).tolist()) * (1 + seed % 4) + b"\0"
    found = suffix_array(np.frombuffer(text, np.uint8).astype(np.int64), tmp_path, {"bytes": 0, "lms": []})
    assert found.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
