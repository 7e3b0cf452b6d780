"""Token ids of whole texts by a public tokenizer, as bytes of little-endian 32-bit integers.

The library encodes every distinct part of a text once per worker. Texts are cut where its own rules
never join what stands on both sides: with ``spaced``, before a space that a character other than
white space follows, and around a line end between two such characters (byte-level BPE, where a word
carries its space); without, before ASCII white space (tokenizers that drop white space); with both,
between Latin letters and ASCII punctuation other than the apostrophe, which contractions start with.
Numpy finds the cuts in the bytes of some megabytes of texts at once, Arrow numbers the distinct
parts and puts the ids of each in its places, so Python handles only those.

New parts of letters or punctuation alone, the bulk, are one word to the library's rules: they go
to its merges directly, many in one call. What tells their ids apart is how many bytes each id stands
for. Other new parts, and texts that may name a special token, go to the library as they are.
"""

from __future__ import annotations

import codecs
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from parcel_engine.llm.common import SPACE, text_buffer

#: Distinct parts a worker learns before it forgets those it has not met since the last time.
REMEMBERED = 400_000

#: Characters of the longest part that a worker remembers; text without spaces is one long part.
LONGEST = 100

#: Bytes of texts that are encoded together.
TOGETHER = 4 << 20

_PLAIN = r"(?:[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+|[!-&(-/:-@\[-`{-~]+)"
_MARKS = [c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'"]

#: Of each byte: 1 for ASCII letters, 2 for ASCII punctuation but for the apostrophe, 0 for others.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(65, 91), *range(97, 123)]] = 1
_KIND[[ord(c) for c in _MARKS]] = 2

#: White space of ``str.isspace``: ASCII bytes, first bytes of others and all of them, bytes that may end one.
_BLANK = SPACE.copy()
_BLANK[28:32] = True
_WIDE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0")) for c in range(128, 0x3001) if chr(c).isspace()])
_LEADS = np.zeros(256, bool)
_LEADS[_WIDE >> 16] = True
_MAY_END = _BLANK.copy()
_MAY_END[[chr(c).encode()[-1] for c in range(128, 0x3001) if chr(c).isspace()]] = True

#: Byte-level alphabet: printable bytes stand for themselves, the others are numbered from 256 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_NUMBERED = {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - _PRINTABLE))}
_ALPHABET = "".join(_NUMBERED.get(b, chr(b)) for b in range(256))
_END = _ALPHABET[10]

_encoders: dict[tuple[str, bool], Encoder] = {}


class Encoder:
    def __init__(self, path: str, spaced: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        names = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.names = re.compile("|".join(names), re.IGNORECASE).search
        self.marks = {re.match(r"\W*", t.content)[0] for t in self.tokenizer.get_added_tokens_decoder().values()}
        self.spaced = spaced
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.plain = re.compile((" ?" if spaced else "[ \t\n\r\f\v]*") + _PLAIN).fullmatch
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        self.sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, i in vocab.items():
            self.sizes[i] = len(token.removesuffix(suffix))
        self.case = self._case()

    def _case(self):
        """How the tokenizer treats capitals; None if its words do not go to the merges as they are."""
        probes = [["Tokens"], ["\u00c9cole"], ["STRA\u00dfE", ",", "a"], [".***"], ["\u00c0\u00ff\u00d6\u00d8", "(", "x"]]
        probes += [[c] for c in (*map(chr, range(65, 91)), *_MARKS)]
        if self.spaced:
            probes = [[" " + first, *rest] for first, *rest in probes]
        want = [np.array(self.tokenizer.encode("".join(p), add_special_tokens=False).ids, "<u4").tobytes() for p in probes]
        for case in (str, str.lower):
            found = iter(self._merged([case(part) for p in probes for part in p]) or ())
            if [b"".join(next(found, b"") for _ in p) for p in probes] == want:
                return case
        return None

    def _merged(self, parts: list[str]) -> list[bytes] | None:
        """Ids of parts of letters or punctuation; None if the ids do not stand for all of their bytes."""
        raw = ("\n".join(parts) + "\n").encode()
        shown = codecs.charmap_decode(raw, "strict", _ALPHABET)[0].replace(_END, " ")
        found = np.array(self.merges.encode_batch_fast([shown], add_special_tokens=False)[0].ids, "<u4")
        ends = np.flatnonzero(np.frombuffer(raw, np.uint8) == 10) - np.arange(len(parts))
        reach = np.cumsum(self.sizes[found])
        at = np.searchsorted(reach, ends) + 1
        if len(found) != at[-1] or (reach[at - 1] != ends).any():
            return None
        at, ids = (4 * at).tolist(), found.tobytes()
        return [ids[a:b] for a, b in zip([0, *at], at)]

    def _cuts(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Where parts start in the bytes of texts that start and end at ``rows``."""
        cut = np.zeros(len(data) + 1, bool)
        if self.spaced:
            blank = _BLANK[data]
            wide = np.flatnonzero(_LEADS[data])
            if len(wide):
                code = [data[np.minimum(wide + k, len(data) - 1)].astype(np.int64) for k in range(3)]
                code = (code[0] << 16) + (code[1] << 8) + np.where(code[0] < 0xE0, 0, code[2])
                blank[wide[np.isin(code, _WIDE)]] = True
            followed = np.append(~blank[1:], False)  # by a character other than white space
            followed[rows[1:][rows[1:] > 0] - 1] = False
            cut[:-1] = (data == 32) & followed
            lines = np.flatnonzero((data == 10) & followed)
            lines = lines[(lines > 0) & ~_MAY_END[data[lines - 1]] & ~np.isin(lines, rows)]
            cut[lines] = cut[lines + 1] = True
        else:
            blank = SPACE[data]
            cut[1:-1] = blank[1:] & ~blank[:-1]
        if self.case:
            kind = _KIND[data]
            latin = np.flatnonzero(data[:-1] == 0xC3)  # U+00C0 to U+00FF
            latin = latin[~np.isin(data[latin + 1], (0x97, 0xB7))]
            kind[latin] = kind[latin + 1] = 1
            cut[1:-1] |= kind[1:] * kind[:-1] == 2
        cut[rows] = True
        return np.flatnonzero(cut[:-1])

    def _learn(self, parts: list[str]) -> None:
        if self.case:
            plain = [p for p in parts if len(p) <= LONGEST and self.plain(p)]
            words = [self.case(p if self.spaced else p.strip()) for p in plain]
            fresh = self._unknown(list(set(words)))
            found = self._merged(fresh) if fresh else []
            if found is not None:
                self.known.update(zip(fresh, found))
                self.known.update(zip(plain, map(self.known.__getitem__, words)))
                parts = [p for p in parts if p not in self.known]
        if parts:
            found = self.tokenizer.encode(parts, is_pretokenized=True, add_special_tokens=False)
            ids = np.array(found.ids, "<u4").tobytes()
            at = (np.searchsorted(np.array(found.word_ids, np.int64), np.arange(len(parts) + 1)) * 4).tolist()
            self.known.update((s, ids[at[i] : at[i + 1]]) for i, s in enumerate(parts))

    def _unknown(self, parts: list[str]) -> list[str]:
        """Those of the parts that are new; older ones are known again."""
        fresh = [p for p in parts if p not in self.known]
        if self.older:
            again = {p: self.older[p] for p in fresh if p in self.older}
            self.known.update(again)
            fresh = [p for p in fresh if p not in again]
        return fresh

    def named(self, text: str) -> bool:
        """Whether the text may hold the name of a special token: such texts go to the library whole."""
        return any(m in text for m in self.marks) and self.names(text) is not None

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text; a null text is an empty one."""
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        marked = np.zeros(len(texts), bool)
        for m in self.marks:
            marked |= pc.match_substring(texts, m).to_numpy(zero_copy_only=False)
        whole = {i: t for i in np.flatnonzero(marked).tolist() if self.named(t := texts[i].as_py())}
        if not whole:
            return self._cut_and_encode(texts)
        found = self.tokenizer.encode_batch_fast(list(whole.values()), add_special_tokens=False)
        ids = {i: np.array(f.ids, "<u4").tobytes() for i, f in zip(whole, found)}
        rest = [i for i in range(len(texts)) if i not in ids]
        ids.update(zip(rest, self._cut_and_encode(texts.take(pa.array(rest, pa.int64())))))
        return [ids[i] for i in range(len(texts))]

    def _cut_and_encode(self, texts: pa.Array) -> list[bytes]:
        data, rows = text_buffer(texts)
        if not len(data):
            return [b""] * len(texts)
        starts = self._cuts(data, rows)
        bounds = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        coded = pa.StringArray.from_buffers(len(starts), bounds, pa.py_buffer(data)).dictionary_encode()
        parts = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > REMEMBERED:
            self.older, self.known = self.known, {}
        fresh = self._unknown(parts)
        if fresh:
            self._learn(fresh)
        ids = pa.array(list(map(self.known.__getitem__, parts)), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64)[np.searchsorted(starts, rows)].tolist()
        out = memoryview(ids.buffers()[2] or b"")
        for p in fresh:
            if len(p) > LONGEST:
                self.known.pop(p)
        return [bytes(out[a:b]) for a, b in zip(ends, ends[1:])]


def encoder(path: str, spaced: bool) -> Encoder:
    """One per worker and tokenizer."""
    key = (path, spaced)
    if key not in _encoders:
        _encoders[key] = Encoder(path, spaced)
    return _encoders[key]


def together(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``TOGETHER`` bytes of a text column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = (np.flatnonzero(np.diff(np.cumsum(sizes) // TOGETHER)) + 1).tolist()
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
        if b > a:
            yield batch.slice(a, b - a)
