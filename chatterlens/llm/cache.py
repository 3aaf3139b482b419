"""A bounded cache of word results for one Python worker."""

from __future__ import annotations


class Generations:
    """Two dictionaries of at most ``size`` entries each: when the young one is full it becomes the old one.

    What is asked for again moves back to the young one, so frequent words stay and memory is bounded.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def look_up(self, keys: list) -> list:
        """The results of all keys, None where there is none."""
        found = list(map(self.young.get, keys))
        if None in found and self.old:
            found = [self.get(k) if x is None else x for k, x in zip(keys, found)]
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
