"""Ids as the tokenizers library gives them, each distinct piece asked for once.

Texts are cut on their bytes, in numpy, where the library's own splitting surely
cuts: before a space that starts a token and, inside words of plain characters,
between letters, digits and marks. Distinct pieces are found by Arrow, and
answers are remembered. A piece that the library would not split further is put
to its model alone, without normalizing, splitting and mapping to bytes again;
any other goes to the library as it is. Texts of which the boundaries are not sure
(they hold the string of an added token, or the tokenizer has other steps) go to it
whole. So all ids are the library's own.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# A space starts a token if what follows is no white space.
JOINING_SPACE = re.compile(r" (?=\S)")
ODD_SPACE = re.compile(r" (?:\s|$)")
# Plain characters: Latin letters without marks of their own, digits, ASCII marks but
# the apostrophe, and a line feed between two others.
LETTERS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
SINGLE = {
    "joined": rf"^(?: ?(?:[{LETTERS}]+|[0-9]+|[{MARKS}]+)|\n)$",
    "dropped": rf"^ ?(?:[{LETTERS}]+|[0-9]|[{MARKS}]+)$",
}
OTHER, SPACE, LETTER, DIGIT, MARK, FEED = range(6)
# White space of two or three bytes: next line, no-break and typographic spaces.
WIDE_SPACE = [0xC285, 0xC2A0, 0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080]
WIDE_SPACE += range(0xE28080, 0xE2808B)
PARTING, NO_BYTE = "\0", "ÿ"
PIECES_KEPT = 500_000
LONGEST_KEPT = 32
PIECES_ASKED = 5000


@lru_cache(maxsize=1)
def byte_classes() -> np.ndarray:
    found = np.full(256, OTHER, np.uint8)
    for kind, pattern in ((LETTER, "[A-Za-z]"), (DIGIT, "[0-9]"), (MARK, f"[{MARKS}]"), (FEED, "\n"), (SPACE, " ")):
        found[[b for b in range(128) if re.match(pattern, chr(b))]] = kind
    return found


def cuts_of(data: np.ndarray, stops: np.ndarray, rule: str) -> np.ndarray:
    """Where pieces start in the bytes of texts that end at ``stops``; every text that is not empty starts one."""
    size = len(data)
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    kind = byte_classes()[padded]
    wide = np.flatnonzero(padded[:size] == 0xC3)
    wide = wide[(padded[wide + 1] != 0x97) & (padded[wide + 1] != 0xB7)]
    kind[wide] = kind[wide + 1] = LETTER

    cut = kind[:size] == SPACE
    if rule == "joined":
        spaces = np.flatnonzero(cut)
        first = padded[spaces + 1].astype(np.int64)
        blank = (first <= 32) & ((first >= 28) | (first >= 9) & (first <= 13))
        led = np.flatnonzero((first == 0xC2) | (first == 0xE1) | (first == 0xE2) | (first == 0xE3))
        if len(led):
            two = first[led] << 8 | padded[spaces[led] + 2]
            three = two << 8 | padded[np.minimum(spaces[led] + 3, size + 2)]
            blank[led] = np.isin(np.where(first[led] == 0xC2, two, three), WIDE_SPACE)
        cut[spaces[blank]] = False
        last = stops[stops > 0] - 1
        cut[last] = False
    starts = np.concatenate([[0], stops[:-1]])
    starts = starts[starts < stops]
    cut[starts] = True

    # A line feed between plain characters is plain; words of plain characters alone are cut inside.
    inner = np.empty(size, bool)
    plain = (kind >= LETTER) & (kind <= MARK)
    feeds = np.flatnonzero(kind[:size] == FEED)
    alone = plain[feeds - 1] & plain[feeds + 1] & ~cut[feeds]
    if len(feeds):
        ends = np.zeros(size + 1, bool)
        ends[stops] = True
        alone &= ~ends[feeds + 1] & ~cut[np.minimum(feeds + 1, size - 1)] & (feeds > 0)
    odd = (kind[:size] == OTHER) | (kind[:size] == SPACE) & ~cut
    odd[feeds[~alone]] = True
    inner[:1] = False
    before, here = kind[: size - 1], kind[1:size]
    inner[1:] = (before != here) & (before != SPACE)
    if rule == "dropped":
        inner[1:] |= (before == DIGIT) & (here == DIGIT)
    words = np.flatnonzero(cut)
    if len(words):
        pure = np.add.reduceat(odd, words, dtype=np.int64) == 0
        inner &= np.repeat(pure, np.diff(np.append(words, size)))
    return np.flatnonzero(cut | inner)


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies have for each byte, as a table for translate."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(others)}}


def space_rule(spec: dict) -> str:
    """How spaces separate: ``joined`` to the next word, ``dropped``, or ``unknown``.

    ``joined``: byte-level splitting by the library's own pattern, no normalizer.
    ``dropped``: white space is made one space and no piece of the split holds one;
    composing and lower-casing do not look past a space.
    """
    normalizer, split = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", [])):
        return "unknown"
    if split.get("type") == "ByteLevel":
        plain = normalizer is None and split["use_regex"] and not split["add_prefix_space"]
        return "joined" if plain else "unknown"
    steps = split.get("pretokenizers", [])
    pattern = steps[0].get("pattern", {}).get("Regex", "") if steps else ""
    before = [n["type"] for n in (normalizer or {}).get("normalizers", [])]
    cuts = (
        len(steps) == 2
        and steps[0]["type"] == "Split"
        and steps[0]["behavior"] == "Removed"
        and steps[0]["invert"]
        and pattern.endswith(r"[^\s\p{L}\p{N}]+")
        and " " not in pattern
        and steps[1] == {**steps[1], "type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
    )
    return "dropped" if cuts and before == ["NFC", "Replace", "Lowercase"] else "unknown"


def flat(found: list[list[int]]) -> np.ndarray:
    return np.concatenate([np.empty(0, "<u4"), *[np.array(i, "<u4") for i in found]])


def joined(pieces: pa.StringArray, mark: str) -> str:
    return pc.binary_join(pa.ListArray.from_arrays([0, len(pieces)], pieces), mark)[0].as_py()


def parted(ids: np.ndarray, mark: int, many: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids without the marks, which must make ``many`` parts, and the size of each part."""
    marks = ids == mark
    ends = np.append(np.flatnonzero(marks), len(ids))
    if len(ends) != many:
        raise RuntimeError("a mark was not kept apart")
    return ids[~marks], np.diff(ends, prepend=-1) - 1


def answered(ask: Callable[[pa.StringArray], tuple[np.ndarray, np.ndarray]], pieces: pa.StringArray) -> Answers:
    """The answers to pieces, asked in runs."""
    runs = [ask(pieces.slice(a, PIECES_ASKED)) for a in range(0, len(pieces), PIECES_ASKED)]
    sizes = np.concatenate([np.empty(0, np.int64), *[n for _, n in runs]])
    ids = np.concatenate([np.empty(0, "<u4"), *[i for i, _ in runs]])
    return Answers(pieces, np.cumsum(sizes) - sizes, sizes, ids)


def gathered(ids: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ids that begin at ``firsts``, one after another, and where each ends."""
    ends = np.cumsum(sizes)
    if not len(ends):
        return ids[:0], ends
    return ids[np.arange(int(ends[-1])) + np.repeat(firsts - ends + sizes, sizes)], ends


def short(pieces: pa.StringArray) -> np.ndarray:
    return pc.less_equal(pc.binary_length(pieces), LONGEST_KEPT).to_numpy(zero_copy_only=False)


@dataclass
class Answers:
    """Pieces, and of each the place and number of its ids."""

    pieces: pa.StringArray
    firsts: np.ndarray
    sizes: np.ndarray
    ids: np.ndarray

    def joined(self, more: Answers) -> Answers:
        return Answers(
            pa.concat_arrays([self.pieces, more.pieces]),
            np.append(self.firsts, more.firsts + len(self.ids)),
            np.append(self.sizes, more.sizes),
            np.append(self.ids, more.ids),
        )

    def only(self, kept: np.ndarray) -> Answers:
        ids, ends = gathered(self.ids, self.firsts[kept], self.sizes[kept])
        return Answers(self.pieces.filter(pa.array(kept)), ends - self.sizes[kept], self.sizes[kept], ids)


def uncached(model: dict):
    """The library's model without its own memory, which pieces that are asked once only slow down."""
    from tokenizers import models

    plain = {"unk_token", "dropout", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges"}
    if model["type"] != "BPE" or any(model.get(name) for name in plain):
        return None
    merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    suffix = model.get("end_of_word_suffix")
    kinds = {"end_of_word_suffix": suffix} if suffix else {}
    return models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0, **kinds)


class LibraryIds:
    """Encodes texts without adding special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        self.rule = space_rule(spec)
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        special = [t for t in spec.get("added_tokens", []) if not t["normalized"]]
        self.between = (special[0]["content"], special[0]["id"]) if special else None
        # The model alone. No UTF-8 text holds the byte 255, so its character can part pieces.
        self.model = Tokenizer(uncached(spec["model"]) or self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.Split(NO_BYTE, "isolated")
        self.letters = {**byte_letters(), ord(PARTING): NO_BYTE}
        (self.parting_id,) = self.model.encode_batch_fast([NO_BYTE], add_special_tokens=False)[0].ids
        self.known = answered(self._ask_apart, pa.array([], pa.string()))

    def _ask(self, texts: list[str]) -> list[list[int]]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [e.ids for e in found]

    def _ask_apart(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The library's ids of pieces, put to it with an added token between them: one call, few objects."""
        if self.between is None:
            found = self._ask(pieces.to_pylist())
            return flat(found), np.array([len(i) for i in found], np.int64)
        mark, mark_id = self.between
        (answer,) = self._ask([joined(pieces, mark)])
        return parted(np.array(answer, "<u4"), mark_id, len(pieces))

    def _ask_model(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The model's ids of pieces that the library would not split."""
        mapped = joined(pieces, PARTING).encode().decode("latin-1").translate(self.letters)
        (answer,) = self.model.encode_batch_fast([mapped], add_special_tokens=False)
        return parted(np.array(answer.ids, "<u4"), self.parting_id, len(pieces))

    def _ask_single(self, pieces: pa.StringArray) -> Answers:
        if self.rule != "dropped" or not len(pieces):
            return answered(self._ask_model, pieces)
        # What differs in case, or in the space before it, is the same to the model.
        names = (PARTING + joined(pieces, PARTING)).lower().replace(PARTING + " ", PARTING)[1:]
        names = pa.array(names.split(PARTING)).dictionary_encode()
        found, kinds = answered(self._ask_model, names.dictionary), names.indices.to_numpy()
        return Answers(pieces, found.firsts[kinds], found.sizes[kinds], found.ids)

    def _ids_of(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces: of each, its first place in the ids returned and its size.

        At most ``PIECES_KEPT`` pieces and those of one batch, and no long ones, are remembered.
        """
        place = pc.index_in(pieces, value_set=self.known.pieces)
        at, fresh = pc.fill_null(place, 0).to_numpy().astype(np.int64), place.is_null()
        single = pc.and_(fresh, pc.match_substring_regex(pieces, SINGLE[self.rule]))
        other = pc.and_not(fresh, single)
        learned = self._ask_single(pieces.filter(single)).joined(answered(self._ask_apart, pieces.filter(other)))
        order = np.concatenate([np.flatnonzero(m.to_numpy(zero_copy_only=False)) for m in (single, other)])
        at[order] = len(self.known.pieces) + np.arange(len(order))
        everything = self.known.joined(learned)
        firsts, sizes = everything.firsts[at], everything.sizes[at]
        if len(everything.pieces) > PIECES_KEPT:
            self.known = Answers(pieces, firsts, sizes, everything.ids).only(short(pieces))
        else:
            self.known = self.known.joined(learned.only(short(learned.pieces)))
        return everything.ids, firsts, sizes

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and where each text's end; texts without added tokens."""
        stops = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        begin, end = int(stops[0]), int(stops[-1])
        if begin == end:
            return np.empty(0, "<u4"), np.zeros(len(texts), np.int64)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[begin:end]
        stops = stops[1:].astype(np.int64) - begin
        cuts = cuts_of(data, stops, self.rule)
        bounds = pa.py_buffer(np.append(cuts, len(data)).astype(np.int32))
        pieces = pa.StringArray.from_buffers(len(cuts), bounds, pa.py_buffer(data)).dictionary_encode()
        ids, firsts, sizes = self._ids_of(pieces.dictionary)
        kinds = pieces.indices.to_numpy()
        ids, ends = gathered(ids, firsts[kinds], sizes[kinds])
        # The pieces of a text are those that start before it stops.
        before = np.searchsorted(cuts, stops)
        return ids, np.where(before > 0, ends[before - 1], 0)

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Little-endian unsigned 32-bit ids of all texts one after another, and where each text's end."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        whole = pa.array(np.ones(len(texts), bool))
        if self.rule != "unknown":
            whole = pa.array(np.zeros(len(texts), bool))
            for content in self.added:
                whole = pc.or_(whole, pc.match_substring(texts, content))
        asked = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(asked):
            return self._split(texts)
        ids, stops = self._split(pc.if_else(whole, "", texts))
        answers = self._ask(texts.take(pa.array(asked)).to_pylist())
        sizes = np.zeros(len(texts), np.int64)
        sizes[asked] = [len(a) for a in answers]
        at = np.repeat(stops[asked], sizes[asked])
        return np.insert(ids, at, flat(answers)), stops + np.cumsum(sizes)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        ids, stops = self.encode_array(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), (4 * stops).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


@lru_cache(maxsize=2)
def library_ids(path: str) -> LibraryIds:
    """One encoder per worker process and file."""
    return LibraryIds(path)
