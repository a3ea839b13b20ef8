"""A bounded cache of finished answers."""

from __future__ import annotations

import hashlib
import json
import time
from collections import OrderedDict
from collections.abc import Callable


class ResultCache:
    """Answers by request, configuration and generation, for ``ttl`` seconds and at most ``size`` of them; the least recently used goes first.

    Only what ``fit`` accepts is kept, so a degraded answer is asked for again.
    """

    def __init__(self, size: int = 256, ttl: float = 300.0, fit: Callable[[object], bool] = lambda _: True, clock: Callable[[], float] = time.monotonic):
        self.size, self.ttl, self.fit, self.clock = size, ttl, fit, clock
        self.kept: OrderedDict[str, tuple[float, object]] = OrderedDict()

    @staticmethod
    def key(request: dict, fingerprint: str, generation: str) -> str:
        return hashlib.sha256(json.dumps([request, fingerprint, generation], sort_keys=True, ensure_ascii=False).encode()).hexdigest()

    def get(self, key: str) -> object | None:
        found = self.kept.get(key)
        if found is None:
            return None
        if self.clock() - found[0] >= self.ttl:
            del self.kept[key]
            return None
        self.kept.move_to_end(key)
        return found[1]

    def put(self, key: str, value: object) -> None:
        if not self.fit(value):
            return
        self.kept[key] = self.clock(), value
        self.kept.move_to_end(key)
        while len(self.kept) > self.size:
            self.kept.popitem(last=False)
