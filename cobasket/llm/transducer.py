"""Byte-pair merges as automata.

Three layers, each small enough to test alone:

* :class:`Merges` holds a tokenizer's tokens as strings of symbols, and the pairs that merge.
* :class:`MergeAutomaton` is the deterministic automaton over *tokens* that accepts exactly the token sequences which
  merging produces. It starts with one state where any token may follow any other and takes one gadget per merge: the
  state that the left part leads to is copied, the copy loses the arc of the right part, and the merged token gets an
  arc to where the right part led. A state is kept in factored form, as the gadgets that shaped it, since the arcs
  written out would be (tokens x tokens).
* :class:`Transducer` is the deterministic automaton over *symbols* that follows from it. Each prefix of a word has
  exactly one tokenization, hence one last token; a state is the set of token starts still open, with the automaton
  state and the relative token count at each. Transitions are computed when first needed and then found in a hash
  table, for whole columns of texts at a time.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np

NEVER = 1 << 60
SYMBOL_BITS = 21
CACHED = 300_000  # entries of a cache
FEW = 4  # runs that go number by number
PART = 1 << 16  # symbols turned into numbers at a time
SINGLE = 50_000  # states in the table of a single run


class Merges:
    """Tokens and merging pairs. ``pairs`` maps (left, right) to (rank, merged); lower ranks merge first.

    ``spell`` gives a token's symbols. ``left``, ``right`` and ``formed`` describe how merging alone builds it, and
    tokens that merging never builds from their own symbols are left out of ``spell``.
    """

    def __init__(self, base: dict[int, int], pairs: dict[tuple[int, int], tuple[int, int]]):
        self.base, self.pairs = base, pairs
        self.spell = {token: (symbol,) for symbol, token in base.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.formed = dict.fromkeys(self.spell, -1)

    def define(self, token: int, a: int, b: int, rank: int) -> None:
        self.left[token], self.right[token] = a, b
        self.spell[token] = self.spell[a] + self.spell[b]
        self.formed[token] = max(rank, self.formed[a], self.formed[b])

    @classmethod
    def from_list(cls, base: dict[int, int], merges: list[tuple[int, int, int]]) -> Merges:
        """From (left, right, merged) in the order of merging."""
        made = cls(base, {(a, b): (rank, ab) for rank, (a, b, ab) in enumerate(merges)})
        for rank, (a, b, ab) in enumerate(merges):
            if a in made.spell and b in made.spell and ab not in made.spell:
                made.define(ab, a, b, rank)
        return made

    @classmethod
    def from_ranks(cls, base: dict[int, int], ranked: list[tuple[tuple[int, ...], int, int]]) -> Merges:
        """From (symbols, token, rank): any two neighbours merge whose joined symbols are a token."""
        by_spelling = {symbols: (rank, token) for symbols, token, rank in ranked}
        of = {(symbol,): token for symbol, token in base.items()} | {s: t for s, (_, t) in by_spelling.items()}
        pairs = {}
        for symbols, (rank, token) in by_spelling.items():
            for cut in range(1, len(symbols)):
                a, b = of.get(symbols[:cut]), of.get(symbols[cut:])
                if a is not None and b is not None:
                    pairs[a, b] = (rank, token)
        made = cls(base, pairs)
        for symbols, token, rank in sorted(ranked, key=lambda x: (x[2], len(x[0]))):
            if all(s in base for s in symbols):
                last = made.merge_all(symbols)
                if len(last) == 3 and last[2] == token and last[0] in made.spell and last[1] in made.spell:
                    made.define(token, last[0], last[1], rank)
        return made

    def merge_all(self, symbols: tuple[int, ...]) -> list[int]:
        """The tokens of ``symbols`` by plain merging; for a single token, (left part, right part, token)."""
        parts, was = [self.base[s] for s in symbols], None
        while len(parts) > 1:
            best = min(((self.pairs[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.pairs),
                       default=None)
            if best is None:
                return parts
            at = best[1]
            was = (parts[at], parts[at + 1])
            parts[at:at + 2] = [self.pairs[was][1]]
        return [*was, parts[0]] if was else parts


class MergeAutomaton:
    """Which token may follow which: the states and arcs that the gadgets leave."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.gadgets: dict[tuple[int, int], int] = {}
        self._times: dict[int, list[int]] = {}
        self._spines: dict[tuple[bool, int], list[tuple[int, int]]] = {}
        self._states: dict[int, int] = {}
        self._ids: dict[tuple, int] = {}
        self._of: list[int] = []
        self._arcs: dict[tuple[int, int], bool] = {}
        formed = merges.formed
        for (a, b), (rank, _) in sorted(merges.pairs.items(), key=lambda x: x[1][0]):
            if a in formed and b in formed:
                self._gadget(a, b, max(rank, formed[a], formed[b]))

    def _gadget(self, a: int, b: int, time: int) -> None:
        """From ``time`` on, b no longer follows a: the state a leads to is replaced by a copy without that arc."""
        if self.follows(a, b):  # else the two never meet, and the automaton stays as it is
            self.gadgets[a, b] = time
            insort(self._times.setdefault(a, []), time)

    def _spine(self, token: int, rightmost: bool) -> list[tuple[int, int]]:
        """The parts at one end of a token, outermost first, each with the time when it is merged away."""
        key = (rightmost, token)
        if key not in self._spines:
            parts, out, until = self.merges.right if rightmost else self.merges.left, [], NEVER
            while token is not None:
                out.append((token, until))
                until, token = self.merges.formed[token], parts.get(token)
            self._spines[key] = out
        return self._spines[key]

    def follows(self, a: int, b: int) -> bool:
        """Has the state that ``a`` leads to an arc for ``b``? Of equal times, the merge further left goes first."""
        gadgets = self.gadgets
        for left, until_left in self._spine(a, True):
            if left in self._times:
                for right, until_right in self._spine(b, False):
                    time = gadgets.get((left, right))
                    if time is not None and time < until_left and time <= until_right:
                        return False
        return True

    def state(self, token: int) -> int:
        """The state that ``token`` leads to, 1 or more. Tokens cut by the same gadgets share it; 0 is the start."""
        found = self._states.get(token)
        if found is None:
            shape = tuple((part, n) for part, until in self._spine(token, True)
                          if (n := bisect_left(self._times.get(part, ()), until)))
            found = self._ids.setdefault(shape, len(self._ids) + 1)
            if found > len(self._of):
                self._of.append(token)
            self._states[token] = found
        return found

    def arc(self, state: int, token: int) -> bool:
        if not state:
            return True
        key = (state, token)
        found = self._arcs.get(key)
        if found is None:
            if len(self._arcs) > CACHED:  # a cache only
                self._arcs.clear()
            found = self._arcs[key] = self.follows(self._of[state - 1], token)
        return found


class Transducer:
    """The deterministic symbol automaton: each transition gives the next state, the last token, and the change of
    the token count. ``unknown`` gives the count of a symbol outside the alphabet, which merges with nothing.

    Tables hold ``max_transitions`` at most; when full, they are emptied and filled anew from the states in use.
    """

    def __init__(self, automaton: MergeAutomaton, unknown=None, max_transitions: int = 1_000_000):
        self.automaton, self.unknown, self.max_transitions = automaton, unknown, max_transitions
        self.trie: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]
        for token, symbols in automaton.merges.spell.items():
            node = 0
            for symbol in symbols:
                step = self.trie[node].get(symbol)
                if step is None:
                    step = self.trie[node][symbol] = len(self.trie)
                    self.trie.append({})
                    self.ends.append(-1)
                node = step
            self.ends[node] = token
        self.below = self._tokens_below()
        self._alike: dict[tuple, int] = {}
        self._narrowed: dict[tuple[int, int], int] = {}
        self._clear()

    def _tokens_below(self) -> list[list[int] | None]:
        """The tokens that a trie node leads to; None for nodes that lead to many. Children follow their parents."""
        below: list[list[int] | None] = [[] for _ in self.trie]
        for node in range(len(self.trie) - 1, -1, -1):
            own: list[int] | None = []
            for child in self.trie[node].values():
                tokens = below[child]
                if own is None or tokens is None or len(own) + len(tokens) > 60:
                    own = None
                    break
                own = own + tokens + ([self.ends[child]] if self.ends[child] >= 0 else [])
            below[node] = own
        return below

    def _narrow(self, node: int, state: int) -> int:
        """A state that treats all tokens below ``node`` as ``state`` does, the same for all such; -1 if none may come."""
        key = (node, state)
        found = self._narrowed.get(key)
        if found is None:
            tokens = self.below[node]
            if tokens is None or not state:
                found = state
            else:
                shut = tuple(t for t in tokens if not self.automaton.arc(state, t))
                found = 0 if not shut else -1 if len(shut) == len(tokens) else \
                    self._alike.setdefault((node, shut), state)
            if len(self._narrowed) > CACHED:  # a cache only
                self._narrowed.clear()
            self._narrowed[key] = found
        return found

    def _clear(self) -> None:
        self._single: tuple[dict, list, dict] = ({}, [], {})  # numbers of states, states, transitions
        self.shapes: list[tuple] = []
        self.ids: dict[tuple, int] = {}
        self._intern(((0, 0, 0),))  # state 0: before any symbol
        self.n = 0
        self.rows = np.zeros((1 << 14, 3), np.int32)  # next state, change of the count, last token
        self._table(1 << 16)

    def _table(self, size: int) -> None:
        self.mask = size - 1
        self.keys = np.full(size, -1, np.int64)
        self.slots = np.zeros(size, np.int32)

    def _intern(self, shape: tuple) -> int:
        found = self.ids.get(shape)
        if found is None:
            found = self.ids[shape] = len(self.shapes)
            self.shapes.append(shape)
        return found

    def _compile(self, shape: tuple, symbol: int) -> tuple[tuple, int, int]:
        """The transition of one state on one symbol: next shape, change of the count, last token."""
        won, count, open_ = None, 0, []
        for node, state, back in shape:
            step = self.trie[node].get(symbol)
            if step is None:
                continue
            token = self.ends[step]
            if token >= 0 and self.automaton.arc(state, token):
                if won is not None:
                    raise ValueError("two tokenizations of one prefix")
                won, count = token, back + 1
            if self.trie[step] and (state := self._narrow(step, state)) >= 0:
                open_.append((step, state, back))
        if won is None:
            if self.unknown is None or symbol in self.trie[0]:
                raise ValueError(f"no tokenization ends at symbol {symbol}")
            return ((0, 0, 0),), self.unknown(symbol), -1
        return (*((n, s, b - count) for n, s, b in open_), (0, self.automaton.state(won), 0)), count, won

    def _hash(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(12)).astype(np.int64) & self.mask

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each transition, -1 where it isn't there."""
        at = self._hash(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.slots[at], -1)
        todo = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & self.mask
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.slots[at[todo[hit]]]
            todo = todo[~hit & (seen >= 0)]
        return out

    def _insert(self, keys: np.ndarray, index: np.ndarray) -> None:
        """Put new keys into free places; of keys that want the same place, one gets it and the others go on."""
        at = self._hash(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            place, first = np.unique(at[free], return_index=True)
            done = free[first]
            self.keys[place], self.slots[place] = keys[done], index[done]
            rest = np.ones(len(keys), bool)
            rest[done] = False
            keys, index, at = keys[rest], index[rest], (at[rest] + (self.keys[at[rest]] >= 0)) & self.mask

    def _learn(self, keys: np.ndarray) -> None:
        keys = np.unique(keys)
        made = []
        for key in keys.tolist():
            shape, change, last = self._compile(self.shapes[key >> SYMBOL_BITS], key & ((1 << SYMBOL_BITS) - 1))
            made.append((self._intern(shape), change, last))
        new = slice(self.n, self.n + len(keys))
        if new.stop > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(len(self.rows), new.stop), 3), np.int32)])
        self.rows[new] = made
        self.n = new.stop
        if 3 * self.n > self.mask:
            old = self.keys >= 0
            old_keys, old_slots = self.keys[old], self.slots[old]
            self._table(4 * (self.mask + 1))
            self._insert(old_keys, old_slots)
        self._insert(keys, np.arange(new.start, new.stop, dtype=np.int32))

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """One symbol for each of many runs: next states, changes of the count, last tokens (-1: unknown symbol).

        States are valid until the tables are emptied, which only :meth:`trim` does.
        """
        keys = (states.astype(np.int64) << SYMBOL_BITS) | symbols
        index = self._find(keys)
        lost = index < 0
        if lost.any():
            self._learn(keys[lost])
            index[lost] = self._find(keys[lost])
        rows = self.rows[index]
        return rows[:, 0], rows[:, 1], rows[:, 2]

    def trim(self) -> None:
        """Empty the tables when they are full. To be called between runs, when no state is in use."""
        if self.n > self.max_transitions:
            self._clear()

    def _alone(self, symbols: np.ndarray, start: int, stop: int, state: int) -> tuple[int, int]:
        """The end state and the change of the count of a single run, with a table of its own: symbols without word
        starts lead to ever new states, so the table begins anew when it is full."""
        numbers, shapes, known = self._single
        total, at = 0, numbers.setdefault(self.shapes[state], len(shapes))
        if at == len(shapes):
            shapes.append(self.shapes[state])
        for first in range(start, stop, PART):
            for symbol in symbols[first:min(first + PART, stop)].tolist():
                key = at << SYMBOL_BITS | symbol
                found = known.get(key)
                if found is None:
                    shape, change, _ = self._compile(shapes[at], symbol)
                    if len(shapes) > SINGLE:
                        for table in (numbers, shapes, known):
                            table.clear()
                        key = -1
                    at = numbers.setdefault(shape, len(shapes))
                    if at == len(shapes):
                        shapes.append(shape)
                    if key >= 0:
                        known[key] = at, change
                    total += change
                else:
                    at = found[0]
                    total += found[1]
        return self._intern(shapes[at]), total

    def run(self, symbols: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray | None = None,
            each=None) -> tuple[np.ndarray, np.ndarray]:
        """Run over many stretches of ``symbols`` side by side: end states and changes of the token count.

        ``each(i, order, last)`` gets the last tokens after the i-th symbol of the stretches in ``order``.
        """
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], lengths[order]
        at = np.zeros(len(order), np.int32) if states is None else states[order].astype(np.int32)
        total = np.zeros(len(order), np.int64)
        longest = int(lengths[0]) if len(order) else 0
        active = np.searchsorted(-lengths, -np.arange(longest), side="left")
        for i in range(longest):
            n = int(active[i])
            if n <= FEW and each is None:  # a few long ones are left: number by number is faster than arrays
                for k in range(n):
                    at[k], more = self._alone(symbols, int(starts[k]) + i, int(starts[k] + lengths[k]), int(at[k]))
                    total[k] += more
                break
            at[:n], change, last = self.step(at[:n], symbols[starts[:n] + i])
            total[:n] += change
            if each is not None:
                each(i, order[:n], last)
        end, count = np.empty_like(at), np.empty_like(total)
        end[order], count[order] = at, total
        return end, count
