"""Encoding texts by their pieces, remembering the ids of the pieces met most often."""

from __future__ import annotations

from abc import ABC, abstractmethod

import numpy as np

from lakepipe.llm.arrays import gather

KEEP = 300_000


class PieceCache(ABC):
    """Ids of texts whose pieces are encoded one by one.

    Holds about KEEP distinct pieces; when they are more, the half that was used most stays.
    """

    def __init__(self) -> None:
        # Pieces are numbered in the order of the dictionary; piece i has flat[start[i]:][:length[i]].
        self.code: dict = {}
        self.flat = np.zeros(0, np.int32)
        self.start = self.length = self.uses = np.zeros(0, np.int64)

    @abstractmethod
    def split(self, text: str) -> list:
        """The pieces of a text."""

    @abstractmethod
    def encode_pieces(self, pieces: list) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(order, ids, ids per piece): `order` tells which pieces the ids are of, one after the other."""

    def _shrink(self) -> None:
        kept = np.sort(np.argsort(-self.uses, kind="stable")[: KEEP // 2])
        pieces = list(self.code)
        self.code = {pieces[i]: n for n, i in enumerate(kept.tolist())}
        self.flat = gather(self.flat, self.start[kept], self.length[kept])
        self.length, self.uses = self.length[kept], self.uses[kept] // 2
        self.start = np.cumsum(self.length) - self.length

    def _learn(self, pieces: list) -> None:
        order, ids, length = self.encode_pieces(pieces)
        base = len(self.start)
        self.code.update(zip([pieces[i] for i in order], range(base, base + len(order))))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(length) - length])
        self.length = np.concatenate([self.length, length])
        self.flat = np.concatenate([self.flat, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(order), np.int64)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, bounds): text t has ids[bounds[t]:bounds[t+1]]."""
        pieces: list = []
        ends = [0]
        for text in texts:
            pieces += self.split(text)
            ends.append(len(pieces))
        known = list(map(self.code.get, pieces))
        if None in known:
            new = {p for p, code in zip(pieces, known) if code is None}
            if len(new) + len(self.code) > KEEP:
                self._shrink()
                new = set(pieces) - self.code.keys()
            self._learn(list(new))
            known = list(map(self.code.__getitem__, pieces))
        codes = np.array(known, np.int64)
        self.uses += np.bincount(codes, minlength=len(self.uses))
        length = self.length[codes]
        before = np.concatenate([[0], np.cumsum(length)])
        return gather(self.flat, self.start[codes], length), before[np.array(ends)]
