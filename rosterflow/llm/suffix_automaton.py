"""A suffix automaton of several token sequences."""

from __future__ import annotations


class SuffixAutomaton:
    """Recognises every run of tokens of any of the sequences, each of which starts anew at the root.

    A state knows the longest run it stands for, its suffix link, and for each sequence that holds its runs
    the end (exclusive) of the first place where it does.
    """

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = []
        for tokens in sequences:
            last = 0
            for token in tokens:
                last = self.extend(last, token)
        self.ends = [{} for _ in self.next]
        for number, tokens in enumerate(sequences):
            state = 0
            for end, token in enumerate(tokens, 1):
                state = at = self.next[state][token]
                while at > 0 and number not in self.ends[at]:
                    self.ends[at][number] = end
                    at = self.link[at]

    def add(self, length: int, link: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def split(self, state: int, target: int, token: int) -> int:
        """The state that stands for the runs of ``target`` up to one token beyond ``state``."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self.add(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(token) == target:
            self.next[state][token] = copy
            state = self.link[state]
        return copy

    def extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            return self.split(last, self.next[last][token], token)
        new = self.add(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and token not in self.next[state]:
            self.next[state][token] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self.split(state, self.next[state][token], token)
        return new

    def stream(self, tokens: list[int]):
        """Matching statistics: for each place the length of the longest run that ends there, and its state."""
        state, length = 0, 0
        for token in tokens:
            while state and token not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if token in self.next[state]:
                state = self.next[state][token]
                length += 1
            else:
                length = 0
            yield length, state
