"""Deterministic transducer of a BPE vocabulary with word ends.

It reads words as bytes, each closed by ``END``, and every transition carries the number of tokens it emits, so
that the emissions of a word sum up to its token count.

State.  The tokens of a prefix of a word are those of a shorter prefix and one more, the prefix's last token: the one
token at its end that stands apart from (``apart``: no merge crosses the boundary) the last token of the prefix
before it.  So reading on needs only the starts from which a token may still grow; a state is the list of these starts
as ``(place in the trie of all tokens, last token before the start, tokens up to the start less the tokens up to
now)``.  The count may fall when a longer token swallows earlier ones: emissions may be negative.  On ``END`` the closed tokens
are tried in the same way, and the state is that of a new word.

Transitions are compiled when data first take them (subset construction of the states met only) into one table,
``state x byte -> next state, emission``.  A state depends on at most the longest token's bytes.  When more than
``max_states`` have been met, the table is begun anew before the next block, so memory is bounded.

Data are read in lanes.  A block of words is cut into chunks of ``LANE`` bytes that all advance by one byte a step.  A
chunk that does not know its entry state waits for a word end; behind it, its states are known.  Its state map is thus
a constant, whatever the entry, and constant maps compose to the last one: every chunk's entry is the exit of the chunk before it.
Only heads, up to the first word end, are then read with the entry; a chunk inside one long word has no word end, its
map is no constant, and is applied when its entry is known.
"""

from __future__ import annotations

import numpy as np

END = 0
LANE = 256
MAX_STATES = 1 << 18
REMEMBERED = 1 << 20
_NEW, _WAIT = 0, 1  # states: a word begins; the entry is not known
_BITS = 6           # an entry of the table is next state << 6 | emission + 32
_LOW = (1 << _BITS) - 1
_ZERO = 32
_END_COLUMN = 0
_NEVER = 1 << 40


class WordTransducer:
    def __init__(self, merges: list[tuple[bytes, bytes]], max_states: int = MAX_STATES):
        """``merges`` in their order, a closed token ending in ``END``."""
        self.max_states = max_states
        self.singles = 512  # ids of bytes and of closed bytes, then of merges
        self.parts: list[tuple[int, int]] = []
        self.pairs: dict[tuple[int, int], int] = {}
        ids = {bytes([b]): b for b in range(256)} | {bytes([b, END]): 256 + b for b in range(256)}
        for rank, (left, right) in enumerate(merges):
            ids.setdefault(left + right, self.singles + rank)
            self.parts.append((ids[left], ids[right]))
            self.pairs.setdefault((ids[left], ids[right]), rank)
        self._apart: dict[tuple[int, int], bool] = {}
        self.edges: dict[int, int] = {}
        self.tokens: dict[int, int] = {}
        self.inner: set[int] = set()  # places of the trie from which a token goes on
        for token, i in ids.items():
            if END in token[:-1] or token == bytes([END]):
                continue
            if i >= self.singles and not self.apart(*self.parts[i - self.singles], formed=True):
                continue  # a token that its own bytes do not give
            node = 0
            for b in token:
                self.inner.add(node)
                node = self.edges.setdefault(node << 8 | b, len(self.edges) + 1)
            self.tokens[node] = i
        self.bytes = [END]  # met so far, by their column of the table
        self.columns = np.zeros(256, dtype=np.int32)
        self._begin()

    def apart(self, left: int, right: int, formed: bool = False) -> bool:
        """Whether no merge crosses the boundary of two tokens.  Their merges are undone, the later one first; a
        pair met on the way merges if its rank comes before those that took its tokens into larger ones.
        ``formed``: the pair itself is not tried, only those that met before it was complete."""
        key = (left, right)
        known = None if formed else self._apart.get(key)
        if known is not None:
            return known
        taken_left = taken_right = self.pairs[key] if formed else _NEVER
        result, first = True, formed
        while True:
            met = None if first else self.pairs.get((left, right))
            first = False
            if met is not None and met < taken_left and met <= taken_right:
                result = False
                break
            made_left, made_right = left - self.singles, right - self.singles
            if made_left < 0 and made_right < 0:
                break
            if made_left > made_right:
                taken_left, left = made_left, self.parts[made_left][1]
            else:
                taken_right, right = made_right, self.parts[made_right][0]
        if not formed:
            if len(self._apart) >= REMEMBERED:
                self._apart.clear()
            self._apart[key] = result
        return result

    # ------------------------------------------------------------ compilation
    def _begin(self) -> None:
        self.states: list[tuple] = [((0, -1, 0),), ()]
        self.index = {self.states[_NEW]: _NEW}
        self.width = 1 << 7
        while self.width < len(self.bytes):
            self.width += 1 << 5
        self.table = np.full((1 << 10, self.width), -1, dtype=np.int32)
        self.table[_WAIT] = _WAIT << _BITS | _ZERO
        self.table[_WAIT, _END_COLUMN] = self.table[_NEW, _END_COLUMN] = _NEW << _BITS | _ZERO

    def _intern(self, key: tuple) -> int:
        state = self.index.get(key)
        if state is None:
            state = self.index[key] = len(self.states)
            self.states.append(key)
            if state >= len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
        return state

    def _compile(self, state: int, column: int) -> int:
        """The transition as an entry of the table."""
        byte = self.bytes[column]
        grown, token, count = [], -1, 0
        for node, last, n in self.states[state]:
            child = self.edges.get(node << 8 | byte)
            if child is None:
                continue
            if token < 0:
                t = self.tokens.get(child, -1)
                if t >= 0 and (last < 0 or self.apart(last, t)):
                    token, count = t, n + 1
            if child in self.inner:
                grown.append((child, last, n))
        if token < 0:
            raise ValueError("the vocabulary's merges give no last token: not a BPE vocabulary")
        if byte == END:
            to = _NEW
        else:
            to = self._intern((*((node, last, n - count) for node, last, n in grown), (0, token, 0)))
        entry = self.table[state, column] = to << _BITS | count + _ZERO
        return int(entry)

    # ------------------------------------------------------------ reading
    def _meet(self, data: np.ndarray) -> np.ndarray:
        """Columns of the bytes; begins anew where the table is full or too narrow for new bytes."""
        new = np.setdiff1d(np.flatnonzero(np.bincount(data, minlength=256)), self.bytes)
        self.columns[new] = np.arange(len(self.bytes), len(self.bytes) + len(new))
        self.bytes += new.tolist()
        if len(self.bytes) > self.width or len(self.states) > self.max_states:
            self._begin()
        return self.columns[data]

    def _step(self, state: np.ndarray, column: np.ndarray) -> np.ndarray:
        at = state * np.int64(self.width) + column
        entry = self.table.reshape(-1).take(at)
        if entry.min(initial=0) < 0:
            new = np.flatnonzero(entry < 0)
            for i in np.unique(at[new]).tolist():
                self._compile(*divmod(i, self.width))
            entry[new] = self.table.reshape(-1).take(at[new])
        return entry

    def _walk(self, state: int, data: np.ndarray, out: np.ndarray) -> int:
        """One lane by itself: the exit state; emissions go to ``out``."""
        emitted = []
        for column in data.tolist():
            entry = int(self.table[state, column])
            if entry < 0:
                entry = self._compile(state, column)
            state = entry >> _BITS
            emitted.append((entry & _LOW) - _ZERO)
        out[:] = emitted
        return state

    def emissions(self, data: np.ndarray) -> np.ndarray:
        """Tokens emitted at every byte of words that are all closed by ``END``."""
        n = len(data)
        if n == 0:
            return np.zeros(0, dtype=np.int8)
        width = min(LANE, n)
        lanes = -(-n // width)
        grid = np.full(lanes * width, _END_COLUMN, dtype=np.int32)
        grid[:n] = self._meet(data)
        grid = grid.reshape(lanes, width)
        columns = np.ascontiguousarray(grid.T)
        out = np.zeros((width, lanes), dtype=np.int8)
        state = np.full(lanes, _WAIT, dtype=np.int32)
        state[0] = _NEW
        for i in range(width):
            entry = self._step(state, columns[i])
            state = entry >> _BITS
            out[i] = (entry & _LOW) - _ZERO
        out = np.ascontiguousarray(out.T)
        self._heads(grid, state, out)
        return out.reshape(-1)[:n]

    def _heads(self, grid: np.ndarray, exits: np.ndarray, out: np.ndarray) -> None:
        ends = grid == _END_COLUMN
        closed = ends.any(axis=1)
        length = np.where(closed, ends.argmax(axis=1) + 1, grid.shape[1])
        todo = np.flatnonzero(closed[:-1]) + 1  # the chunk before has a word end: its exit is known
        if not closed[0]:
            todo = np.concatenate([[1], todo])  # the first chunk's entry is known
        todo = todo[todo < len(grid)]
        lane, state = todo, exits[todo - 1]
        for i in range(int(length[todo].max()) if len(todo) else 0):
            on = length[lane] > i
            lane, state = lane[on], state[on]
            entry = self._step(state, grid[lane, i])
            state = entry >> _BITS
            out[lane, i] = (entry & _LOW) - _ZERO
            inside = ~closed[lane]
            exits[lane[inside]] = state[inside]
        for k in np.flatnonzero(~closed[:-1]) + 1:  # behind a chunk inside a long word, one after another
            if k > 1 or closed[0]:
                exit_state = self._walk(int(exits[k - 1]), grid[k, :length[k]], out[k, :length[k]])
                if not closed[k]:
                    exits[k] = exit_state

    def counts(self, streams: list[bytes]) -> list[int]:
        """Tokens of each stream of closed words."""
        total = np.cumsum(self.emissions(np.frombuffer(b"".join(streams), dtype=np.uint8)), dtype=np.int64)
        ends = np.cumsum([len(s) for s in streams])
        upto = np.where(ends > 0, np.concatenate([[0], total])[ends], 0)
        return np.diff(upto, prepend=0).tolist()
