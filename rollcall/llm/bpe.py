"""Byte-level BPE by a tokenization automaton.

The automaton reads *tokens*; it accepts exactly the token sequences that BPE
produces.  It is built from the merge list, one gadget per merge:

* at first there is one state, and every byte label loops on it;
* merge ``(u, v) -> w`` takes the state ``p`` that ``u`` arcs lead to, makes a
  copy ``p'`` of it without its ``v`` arc, turns the ``u`` arcs to ``p'`` (after
  ``u`` no ``v`` may follow any more), and gives every state with a ``u`` arc a
  ``w`` arc to where ``p`` went by ``v``.

All arcs of one label always lead to one state, so a state is named by the
label that leads to it and the number of its copies made so far: ``(u, k)``.
A state's arcs are those of the state it was copied from, minus the label it
dropped, plus the labels added later by the rule above; ``_Automaton.arc``
looks that up in a few steps and the encoder keeps the answers in a table.

Encoding: each prefix of a word has exactly one accepted token sequence, so one
pass from left to right with table look-ups fixes the last token of every
prefix.  Decoding emits the label of each arc.

Edge cases: null and empty texts give no tokens; special-token strings in a
text become their ids, as the tokenizer file defines; rows are independent, so
repeated rows and ties are encoded alike; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_right
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from .common import arrow_rows, texts

#: fixed value: the byte-level pre-tokenizer's pattern
PRE_SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: words kept in a worker's table of encoded words; when full it starts anew
WORD_TABLE = 300_000
#: longer words are rare and not worth a place in the table
WORD_TABLE_MAX_LEN = 64


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(keep)]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Automaton:
    """Tokens are numbered by id; ``arc(u, w)``: may ``w`` follow ``u``?"""

    def __init__(self, singles: list[int], merges: list[tuple[int, int, int]]):
        self.step: dict[int, int] = dict.fromkeys(singles, 0)
        self.left: dict[int, int] = {}
        self.base: dict[int, tuple[int, int] | None] = dict.fromkeys(singles)
        self.copies: dict[int, list[int]] = {s: [] for s in singles}
        self.merged: dict[tuple[int, int], int] = {}
        for i, (u, v, w) in enumerate(merges, 1):
            if w in self.step:
                raise ValueError(f"two merges make token {w}")
            if u not in self.step or v not in self.step or not self._has((u, len(self.copies[u])), v):
                continue  # no text reaches this merge
            self.step[w], self.left[w], self.copies[w] = i, u, []
            self.base[w] = (v, len(self.copies[v]))
            self.copies[u].append(i)
            self.merged[u, v] = i

    def _has(self, state: tuple[int, int] | None, w: int) -> bool:
        while state is not None:
            u, k = state
            if not k:
                state = self.base[u]
                continue
            made = self.copies[u][k - 1]
            if self.step[w] >= made:
                w = self.left[w]  # added wherever its left part has an arc
            else:
                if self.merged.get((u, w), made + 1) <= made:
                    return False
                state = (u, bisect_right(self.copies[u], self.step[w]))
        return True

    def arc(self, u: int, w: int) -> bool:
        return self._has((u, len(self.copies[u])), w)


class Codec:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        plain = (pre["type"] == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"]
                 and spec["normalizer"] is None and not model.get("ignore_merges"))
        if not plain or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level BPE file")
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        label = {i: bytes(back[c] for c in t) for t, i in model["vocab"].items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        vocab = model["vocab"]
        self.automaton = _Automaton([vocab[c] for c in alphabet.values()],
                                    [(vocab[a], vocab[b], vocab[a + b]) for a, b in merges])
        #: prefix tree over the labels: byte -> node, None -> token
        self.tree: dict = {}
        for t in self.automaton.step:
            node = self.tree
            for byte in label[t]:
                node = node.setdefault(byte, {})
            node[None] = t
        self.size = {t: len(label[t]) for t in self.automaton.step}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_split = (regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)))
                              if self.special else None)
        label |= {i: s.encode() for s, i in self.special.items()}
        self.label = label
        self.label_of_text = {str(i): b for i, b in label.items()}
        self.find = regex.compile(PRE_SPLIT).findall
        #: the part of the transition table met so far, a row for each state
        self.arcs: dict[int, dict[int, bool]] = {}
        self.words: dict[str, str] = {}

    def encode_word(self, word: bytes) -> list[int]:
        n, tree, size = len(word), self.tree, self.size
        last: list[int | None] = [None] * (n + 1)
        for i in range(n):
            state, node = last[i], tree
            row = self.arcs.setdefault(state, {}) if i else None
            for j in range(i, n):
                node = node.get(word[j])
                if node is None:
                    break
                t = node.get(None)
                if t is None or last[j + 1] is not None:
                    continue
                if i:
                    ok = row.get(t)
                    if ok is None:
                        ok = row[t] = self.automaton.arc(state, t)
                    if not ok:
                        continue
                last[j + 1] = t
        out, j = [], n
        while j:
            out.append(t := last[j])
            j -= size[t]
        return out[::-1]

    def _word(self, word: str) -> str:
        s = ",".join(map(str, self.encode_word(word.encode())))
        if len(word) <= WORD_TABLE_MAX_LEN:
            if len(self.words) >= WORD_TABLE:
                self.words.clear()
                self.arcs.clear()
            self.words[word] = s
        return s

    def _plain(self, text: str) -> list[str]:
        get, make = self.words.get, self._word
        return [get(w) or make(w) for w in self.find(text)]

    def encode_text(self, text: str) -> str:
        """Decimal ids joined by commas."""
        if self.special_split is None or not (hits := list(self.special_split.finditer(text))):
            return ",".join(self._plain(text))
        parts, at = [], 0
        for m in hits:
            parts += self._plain(text[at:m.start()])
            parts.append(str(self.special[m.group()]))
            at = m.end()
        return ",".join(parts + self._plain(text[at:]))

    def decode_text(self, ids: str) -> str:
        """Text of decimal ids joined by commas."""
        if not ids:
            return ""
        return b"".join(map(self.label_of_text.__getitem__, ids.split(","))).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process and file."""
    return Codec(path)


def encode(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, ids array<int>)`` of every whole text."""
    def run(batches):
        c = codec(path)
        for b in batches:
            yield {id_column: b.column(0),
                   "ids": [[int(x) for x in s.split(",")] if (s := c.encode_text(t)) else [] for t in texts(b, text_column)]}
    src = docs.select(id_column, text_column)
    return arrow_rows(src, f"{id_column} {src.schema[id_column].dataType.simpleString()}, ids array<int>", run)


def decode(tokens: DataFrame, path: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``(id, text)`` of every id sequence; null ids give an empty text."""
    def run(batches):
        c = codec(path)
        for b in batches:
            yield {id_column: b.column(0),
                   "text": [c.decode_text(",".join(map(str, x or ()))) for x in b.column(ids_column).to_pylist()]}
    src = tokens.select(id_column, ids_column)
    return arrow_rows(src, f"{id_column} {src.schema[id_column].dataType.simpleString()}, text string", run)


def round_trip_digests(docs: DataFrame, path: str) -> DataFrame:
    """Encode and decode every whole text; ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``.  Both directions run in one pass so ids of the corpus
    never travel between processes."""
    def run(batches):
        c = codec(path)
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in texts(b):
                s = c.encode_text(t)
                n.append(s.count(",") + 1 if s else 0)
                ids_sha.append(hashlib.sha256(s.encode()).hexdigest())
                text_sha.append(hashlib.sha256(c.decode_text(s).encode()).hexdigest())
            yield {"doc_id": b.column(0), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}
    src = docs.select("doc_id", "text")
    return arrow_rows(src, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, n_tokens bigint, "
                           "ids_sha256 string, decoded_sha256 string", run)
