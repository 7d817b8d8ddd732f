"""A bounded mapping that keeps what is used."""

from __future__ import annotations


class Recent:
    """A bounded mapping: two generations, of which the older one is dropped when the newer is full."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def get(self, key):
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value
