from __future__ import annotations

import pyarrow as pa

from strata.llm.graph import lean


def test_results_pass_and_memory_is_given_back_after_each(monkeypatch):
    given: list[str] = []

    class Pool:
        def __init__(self, name):
            self.name = name

        def release_unused(self):
            given.append(self.name)

    monkeypatch.setattr(pa, "default_memory_pool", lambda: Pool("default"))
    monkeypatch.setattr(pa, "system_memory_pool", lambda: Pool("system"))
    run = lean(lambda batches: (x * 2 for x in batches))([1, 2])
    assert next(run) == 2 and given == []
    assert list(run) == [4] and given == ["default", "system"] * 2
