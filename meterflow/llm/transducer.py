"""A minimal acyclic transducer: words to number sequences, in one flat file.

Words share prefixes by construction and suffixes by merging equal states. A transition holds
how many words come before it, so the sums along a word's path give the word's place in order,
and with it the word's output. The file is memory-mapped; all workers of a machine share it.

File: five 4-byte counts (states, transitions, words, output numbers, 0), then the state
starts, transition targets, transition skips, output starts and outputs as 4-byte numbers, then
one label byte per transition, and one byte per state that is 1 where a word ends.
"""

import mmap
import struct

import numpy as np

SINGLE = [bytes([byte]) for byte in range(256)]
# Where the first letters of words lead is kept, for so many beginnings.
FIRST, KEPT_FIRSTS, MISSING = 4, 50_000, object()


def compile_words(outputs, path):
    """Write the transducer of ``{word bytes: sequence of numbers}``."""
    words = sorted(outputs)
    # A state is its transitions [(label, target)] and whether a word ends there. States of the
    # last word's path are open; a state is settled, and merged with an equal one, when the
    # next word leaves it.
    settled, register = [], {}

    def settle(state):
        key = (state[1], tuple(state[0]))
        found = register.get(key)
        if found is None:
            found = register[key] = len(settled)
            settled.append(key)
        return found

    path_states, last = [[[], False]], b""
    for word in words:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        while len(path_states) > shared + 1:
            state = path_states.pop()
            path_states[-1][0].append((last[len(path_states) - 1], settle(state)))
        for _ in word[shared:]:
            path_states.append([[], False])
        path_states[-1][1] = True
        last = word
    while len(path_states) > 1:
        state = path_states.pop()
        path_states[-1][0].append((last[len(path_states) - 1], settle(state)))
    root = settle(path_states[0])

    # Targets are settled before their sources, so one pass counts the words of every state.
    counts, starts, labels, targets, skips = [], [0], bytearray(), [], []
    for ends, transitions in settled:
        total = int(ends)
        for label, target in transitions:
            labels.append(label)
            targets.append(target)
            skips.append(total)
            total += counts[target]
        counts.append(total)
        starts.append(len(labels))
    sequences = [outputs[word] for word in words]
    output_starts = np.zeros(len(words) + 1, np.uint32)
    output_starts[1:] = np.cumsum([len(s) for s in sequences])
    flat = [number for sequence in sequences for number in sequence]
    with open(path, "wb") as file:
        file.write(struct.pack("<5I", len(settled), len(labels), len(words), len(flat), root))
        for numbers in (starts, targets, skips, output_starts, flat):
            file.write(np.asarray(numbers, np.uint32).tobytes())
        file.write(labels)
        file.write(bytes(int(ends) for ends, _ in settled))


class Transducer:
    """Look words up in a compiled file."""

    def __init__(self, path):
        with open(path, "rb") as file:
            self.file = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        states, transitions, self.words, flat, self.root = struct.unpack("<5I", self.file[:20])
        at, parts = 20, []
        for length in (states + 1, transitions, transitions, self.words + 1, flat):
            parts.append(memoryview(self.file)[at:at + 4 * length].cast("I"))
            at += 4 * length
        self.starts, self.targets, self.skips, self.output_starts, self.outputs = parts
        self.labels, self.ends = at, at + transitions
        self.find, self.firsts = self.file.find, {}

    def __len__(self):
        return self.words

    def _walk(self, state, place, letters):
        """(state, place) behind the letters, or None if there is no such path."""
        find, starts, labels = self.find, self.starts, self.labels
        targets, skips = self.targets, self.skips
        for label in letters:
            found = find(SINGLE[label], labels + starts[state], labels + starts[state + 1])
            if found < 0:
                return None
            found -= labels
            place += skips[found]
            state = targets[found]
        return state, place

    def get(self, word):
        """The numbers of a word, or None if it is not among the compiled ones."""
        first = word[:FIRST]
        at = self.firsts.get(first, MISSING)
        if at is MISSING:
            at = self._walk(self.root, 0, first)
            if len(self.firsts) < KEPT_FIRSTS:
                self.firsts[first] = at
        if at is not None and len(word) > FIRST:
            at = self._walk(*at, word[FIRST:])
        if at is None or not self.file[self.ends + at[0]]:
            return None
        place = at[1]
        return self.outputs[self.output_starts[place]:self.output_starts[place + 1]].tolist()
