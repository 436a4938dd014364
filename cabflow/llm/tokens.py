"""Use of a public BPE tokenizer on columns of texts, with the ids that the ``tokenizers`` library gives.

Plain texts go to ``tiktoken``, which merges several times faster: with ids that
follow the order of the merges, merging by rank is the same as merging by rule.
The end-of-word suffix of a word BPE is written as a control character behind
each word; that character's own merges come first, so that merging starts from
the same symbols. Texts with characters outside the plain set, and tokenizers of
another make, go to the library itself.
"""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cabflow.llm.common import once, ragged

_END = "\x01"
_MARK = "\x02"
# Byte BPE: what may not be cut before a space, as white space in a row is split by what follows.
_IRREGULAR = r"[\t\r\x{a0}]|[ \n][ \n]"
# Characters that are in normal form, have plain lower-case letters and one class in any Unicode version.
_PLAIN = r"^[\t\n\r\x20-\x7e\x{a0}-\x{ff}\x{2010}-\x{2027}\x{20ac}]*$"
_GAP = r"\s\x{a0}"
# The splitting rule of the word BPE, as its file states it.
_WORD_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer(path: str):
    """The tokenizer, without truncation or padding; one for each Python worker."""
    return once(("tokenizer", path), lambda: _load(path))


def _load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def _fast(spec: dict):
    """(tiktoken encoding, whether it takes words with ends) for the two public makes of tokenizer, else None."""
    import public_tokenizers
    import tiktoken

    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
    steps = pre.get("pretokenizers") or []
    norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
    by_word = (
        bool(suffix)
        and [s.get("type") for s in steps] == ["Split", "ByteLevel"]
        and norm == ["NFC", "Replace", "Lowercase"]
        and steps[0]["pattern"].get("Regex") == _WORD_RULE
        and steps[0]["behavior"] == "Removed"
        and steps[0]["invert"]
        and not steps[1]["use_regex"]
    )
    by_byte = not suffix and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not spec.get("normalizer")
    if not (by_word or by_byte) or pre.get("add_prefix_space") or model.get("ignore_merges"):
        return None
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    if any(x >= y for x, y in zip(made[:-1], made[1:], strict=True)) or min(made) < len(vocab) - len(made):
        return None  # ids do not follow the order of the merges
    ranks = {}
    for token, i in vocab.items():
        if token in added:
            continue
        ends = bool(suffix) and token.endswith(suffix) and token != suffix
        ranks[_token_bytes(token[: -len(suffix)] if ends else token) + (_END.encode() if ends else b"")] = i
    if by_word:
        return tiktoken.Encoding("words", pat_str=rf"[^{_END}\s]+{_END}", mergeable_ranks=ranks, special_tokens={}), True
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), False


class TextEncoder:
    """Encodes columns of texts; ``drops_space``: the tokenizer discards white space."""

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        self.drops_space = not self._ids([" "])[0]
        fast = _fast(json.loads(self.tok.to_str()))
        self.fast, self.by_word = fast or (None, False)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, end to end, and each text's offset among them."""
        n = len(texts)
        lengths, parts = np.zeros(n, np.int64), []
        plain = np.zeros(n, bool)
        if self.fast and n:
            plain = pc.and_(pc.match_substring_regex(texts, _PLAIN), pc.invert(pc.match_substring(texts, "<|")))
            if not self.by_word:
                plain = pc.and_(plain, pc.invert(pc.match_substring_regex(texts, _IRREGULAR)))
            plain = plain.to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(plain)
        if len(rows):
            ids, lengths[rows] = self._by_pieces(texts if len(rows) == n else texts.take(pa.array(rows)))
            parts.append(ids)
        rest = np.flatnonzero(~plain)
        for at in range(0, len(rest), 64):
            some = rest[at : at + 64]
            found = self._ids(texts.take(pa.array(some)).to_pylist())
            lengths[some] = [len(x) for x in found]
            parts += [np.array(x, np.int32) for x in found]
        offsets = np.r_[0, np.cumsum(lengths)]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.int32)
        if len(rest) and len(rows):  # plain texts came first
            order = np.r_[rows, rest]
            starts = np.zeros(n, np.int64)
            starts[order] = np.cumsum(lengths[order]) - lengths[order]
            flat = flat[ragged(starts, lengths)]
        return flat, offsets

    def _by_pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts, and how many each has: every distinct piece between spaces is encoded once."""
        if self.by_word:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        else:
            marked = pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", _MARK + "\n")
            lists = pc.split_pattern(marked, _MARK)
        coded = lists.flatten().dictionary_encode()
        flat, each = self._distinct(coded.dictionary)
        starts = (np.cumsum(each) - each).astype(np.int32)
        which = coded.indices.to_numpy(zero_copy_only=False)
        sizes = each[which]
        ends = np.cumsum(sizes, dtype=np.int64)
        take = np.repeat(starts[which] - (ends - sizes).astype(np.int32), sizes)
        take += np.arange(len(take), dtype=np.int32)
        at = np.asarray(lists.offsets.to_numpy(zero_copy_only=False), np.int64)
        return flat[take], np.diff(np.r_[0, ends][at - at[0]])

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, end to end, and how many each has.

        The pieces go to the library as one text; a mark that no piece holds, and that
        stands alone by the splitting rule, tells them apart.
        """
        alone: dict[int, np.ndarray] = {}
        if self.by_word:
            rule = _WORD_RULE.replace(r"\s", _GAP)
            words = pc.replace_substring_regex(pc.utf8_lower(pieces), f"({rule})", rf"\1{_END}").to_pylist()
            mark = _MARK + _END
        else:
            words, mark = pieces.to_pylist(), " " + _MARK
            for i, w in enumerate(words):
                if w[:1] not in (" ", "\n"):  # a text's first piece: the mark before it could join it
                    alone[i] = self.fast.encode_to_numpy(w, disallowed_special=())
                    words[i] = ""
        stop = self.fast.encode_to_numpy(mark, disallowed_special=())
        ids = self.fast.encode_to_numpy(mark.join(words) + mark, disallowed_special=()).astype(np.int32)
        ends = np.flatnonzero(ids == stop[-1])
        if len(ends) != len(words):
            raise ValueError("the mark between pieces was not told apart")
        starts = np.r_[0, ends[:-1] + 1]
        each = (ends - (len(stop) - 1) - starts).astype(np.int32)
        if not alone:
            return ids[ragged(starts, each)], each
        kept, n = ids[ragged(starts, each)], each.copy()
        parts, last, at = [], 0, np.cumsum(each)
        for i, x in alone.items():
            parts += [kept[last : at[i]], x.astype(np.int32)]
            last, n[i] = at[i], len(x)
        return np.concatenate([*parts, kept[last:]]), n


def text_encoder(path: str) -> TextEncoder:
    return once(("encoder", path), lambda: TextEncoder(path))


class Decoder:
    """Ids to text as the library's decode does, for the two kinds of decoder of the public files.

    Without a decoder the tokens' strings are joined by a space; a byte-level
    decoder joins the tokens' bytes, with the replacement mark for bytes that are
    not UTF-8. Ids outside the vocabulary yield nothing. Another kind of decoder
    goes to the library.
    """

    def __init__(self, path: str):
        self.tok = tokenizer(path)
        kind = (json.loads(self.tok.to_str()).get("decoder") or {}).get("type")
        self.mode = {None: "join", "ByteLevel": "bytes"}.get(kind, "library")
        size = max(self.tok.get_vocab(with_added_tokens=True).values()) + 1
        pieces = [self.tok.id_to_token(i) for i in range(size)]
        if self.mode == "join":
            raw = [None if p is None else p.encode() + b" " for p in pieces]
        else:
            raw = [None if p is None else _token_bytes(p) for p in pieces]
        self.known = np.array([p is not None for p in raw])
        self.pieces = pa.array([p or b"" for p in raw], pa.binary())

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        if self.mode == "library":
            return [
                self.tok.decode(ids[a:b].tolist(), skip_special_tokens=False)
                for a, b in zip(offsets[:-1], offsets[1:], strict=True)
            ]
        keep = (ids >= 0) & (ids < len(self.known))
        keep[keep] = self.known[ids[keep]]
        at = np.r_[0, np.cumsum(keep)][offsets]
        taken = self.pieces.take(pa.array(ids[keep]))
        _, where, data = taken.buffers()
        byte_at = np.frombuffer(where, np.int32)[: len(taken) + 1]
        view = memoryview(data) if data is not None else memoryview(b"")
        cut = 1 if self.mode == "join" else 0
        out = []
        for a, b in zip(byte_at[at[:-1]], byte_at[at[1:]], strict=True):
            out.append(str(view[a : max(a, b - cut)], "utf-8", "replace"))
        return out


def _byte_of() -> dict[str, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the rest follow from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


def _token_bytes(token: str) -> bytes:
    table = once(("bytes",), _byte_of)
    if all(c in table for c in token):
        return bytes(table[c] for c in token)
    return token.encode()


def decoder(path: str) -> Decoder:
    return once(("decoder", path), lambda: Decoder(path))
