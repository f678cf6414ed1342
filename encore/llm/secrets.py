"""Secret scan: fixed patterns, and strings that zstandard finds novel.

Patterns (leftmost, not overlapping, kind by kind): ``assign``, a sensitive
name with a value of six characters or more; ``access``, an access key id of
20 characters or more; ``hex``, a run of 24 or more hexadecimal digits.

Novelty: a candidate is a run of 16 or more key characters, of any classes,
near a sensitive word: the run, or the dotted token it is part of, begins at
most ``REACH`` code points after a word or ends so many before one, or holds
one. Where words stand in a run, what they leave of it is tried too. Its
marginal cost is the compressed size of the candidate with a raw-content
dictionary of identifiers and the text around it (without the candidate),
less that of nothing. Ordinary names, words of the text and repeats compress
to little; a random string costs its entropy. Candidates whose cost is at
least ``MIN_NOVEL`` bytes and ``RANDOM_SHARE`` of what random strings of their
alphabet and length cost are reported as ``novel`` unless they overlap a span
of the patterns. (From about 64 bytes on zstandard codes the literals by
frequency, so a random string costs its alphabet's entropy and no longer a
byte a character.) Below that, literals cost a byte each and a long word as
much as a random string. So the cost of a run without digits is measured a
second time as what follows ``ORDINARY`` text, whose letter frequencies then
code it, and must be ``ORDINARY_SHARE`` of a random string's there as well.

Defined results: a null text counts as empty (no spans). Each input row gives
its own row. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import random
import re
from bisect import bisect_left, bisect_right
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.common import bounded_batches

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# Words after or around which a string may be a secret.
_SENSITIVE = re.compile(
    r"password|passwd|passphrase|secret|token|api[ _-]?key|access[ _-]?key|private[ _-]?key|credential|bearer"
    r"|authorization|client[ _-]?id|signature|auth\b|\bkey\b",
    re.IGNORECASE | re.ASCII,
)
_SENSITIVE_HINTS = (
    "passw", "passp", "secret", "token", "key", "credential", "bearer", "auth", "client", "signature",
)
MIN_RUN = 16
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}={{0,2}}")
_RUN = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
# Runs that dots join, or a line break behind a run of 16 or more (an encoded block).
_DOTTED = re.compile(rf"{_RUN.pattern}(?:(?:\.|(?<=[A-Za-z0-9+/_=-]{{{MIN_RUN}}})\r?\n[ \t]*){_RUN.pattern})*")
REACH = 60  # code points between a sensitive word and a candidate, or the dotted token it is part of
AROUND = 1500  # code points of text on each side that prime the dictionary
MIN_NOVEL = 16
RANDOM_SHARE = 0.85  # of the cost of a random string
ORDINARY_SHARE = 0.8  # the same where both follow ordinary text
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# What keys are written in, smallest first; dashes group digits, hex and base32.
ALPHABETS = tuple(sorted((
    _DIGITS, _DIGITS + "-", _DIGITS + "abcdef", _DIGITS + "abcdef-", _DIGITS + "ABCDEF", _DIGITS + "ABCDEF-",
    _LOWER, _UPPER, _UPPER + "234567", _UPPER + "234567-", _LOWER + "234567", _LOWER + _DIGITS, _UPPER + _DIGITS,
    _LOWER + _UPPER, _LOWER + _UPPER + _DIGITS, _LOWER + _UPPER + _DIGITS + "+/", _LOWER + _UPPER + _DIGITS + "-_",
    _LOWER + _UPPER + _DIGITS + "+/-_",
), key=len))
_SETS = tuple(map(frozenset, ALPHABETS))
EXACT = 512  # lengths up to here are drawn as they are, longer ones to the next lower power of two
# Names that code is full of; they prime the dictionary.
IDENTIFIERS = (
    "access_token refresh_token client_secret client_id api_key secret_key private_key public_key password username "
    "authorization bearer credentials signature session cookie config settings environment variable connection string "
    "database host port user default example placeholder changeme your_api_key_here xxxxxxxxxxxxxxxx 0123456789abcdef "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789 function return import class public static void "
    "identifier name of the index value number type key item list count total size length path file data info "
    "https http www com org net index html response request header content type application json "
)

# Ordinary words and names, after whose letters those of a run without digits are coded.
ORDINARY = (
    "the of and to in is that for with are this on as be by from was which not have has were their been would "
    "there when other into more some time only than could these about after between before because people while "
    "should under where state world through during against system number public general government development "
    "different information international understanding der die und in den von zu das mit sich des auf ist im dem "
    "nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem einen "
    "so zum haben nur oder aber vor zur bis mehr durch man sein wurde sei verordnung versicherung verwaltung "
    "gesellschaft le la les de des du et un une est dans pour que qui sur avec pas plus par ce il au se ne sont "
    "mais comme ou nous leur aussi cette entre sans tout fait gouvernement constitution el los las de en que y "
    "por con para una se no es al lo su como pero sus ya este porque esta cuando muy sobre tambien hasta hay "
    "donde quien desde todo nos durante getName setValue createUser addListener isEnabled hasNext toString "
    "onClick numberOf initializeConnection validateRequest AbstractFactory ApplicationContext ServiceImpl "
    "DataSource BeanFactory Controller Manager Builder Handler Provider Configuration Properties Exception "
    "Registry MAX_SIZE DEFAULT_TIMEOUT ERROR_CODE CONNECTION_LIMIT ENABLED STATUS "
    "/usr/local/share/lib/jenkins/workspace/etc/ssl/certs/var/log/home/user/src/main well-known state-of-the-art "
    "docker-compose-production kubernetes-cluster "
)


def _cost(text: bytes, primed, after: bytes = b"") -> int:
    """Compressed bytes of ``text`` that follows ``after``, less those of ``after`` alone."""
    import zstandard

    made = zstandard.ZstdCompressor(
        level=9, dict_data=primed, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    return len(made.compress(after + text)) - len(made.compress(after))


def novelty(text: str, start: int, end: int, after: str = "", copies: bool = True) -> int:
    """Marginal compressed bytes of ``text[start:end]`` against what stands around it.

    Without ``copies`` other places of the string itself are taken out, since
    they make any string that stands twice look familiar.
    """
    import zstandard

    sides = [text[max(0, start - AROUND) : start], text[end : end + AROUND]]
    around = "\n".join(sides if copies else (side.replace(text[start:end], "\n") for side in sides))
    primed = zstandard.ZstdCompressionDict(
        (IDENTIFIERS + around).encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT
    )
    return _cost(text[start:end].encode("utf-8"), primed, after.encode())


@lru_cache(maxsize=None)
def _drawn(alphabet: int, length: int, after: str) -> float:
    """Mean cost of random strings, drawn with a fixed seed."""
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    rng = random.Random(f"{alphabet} {length}")
    draws = ["".join(rng.choices(ALPHABETS[alphabet], k=length)) for _ in range(20)]
    return sum(_cost(d.encode(), primed, after.encode()) for d in draws) / len(draws)


def random_cost(run: str, after: str = "") -> float:
    """What random strings of the run's alphabet (the smallest that holds it) and length cost."""
    used = set(run.rstrip("="))
    alphabet = next(i for i, letters in enumerate(_SETS) if used <= letters)
    length = len(run)
    drawn = length if length <= EXACT else min(1 << (length.bit_length() - 1), 1 << 16)
    return _drawn(alphabet, drawn, after) * length / drawn


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns."""
    found = []
    low = text.lower()
    if any(h in low for h in _ASSIGN_HINTS):
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _candidates(text: str) -> list[tuple[int, int]]:
    """Runs of key characters in reach of a sensitive word, and what words inside a run leave of it."""
    words = [m.span() for m in _SENSITIVE.finditer(text)]
    starts, ends = [w[0] for w in words], [w[1] for w in words]
    found = []
    for token in _DOTTED.finditer(text) if words else ():
        first, last = bisect_left(ends, token.start() - REACH), bisect_right(starts, token.end() + REACH)
        if first >= last:
            continue
        for run in _RUN.finditer(text, *token.span()):
            start, end = run.span()
            if end - start < MIN_RUN:
                continue
            inside = words[bisect_right(ends, start) : bisect_left(starts, end)]
            if last - first > len(inside):
                found.append((start, end))
            edges = [start, *(at for w in inside for at in w), end]
            for left, right in zip(edges[::2], edges[1::2]) if inside else ():
                found += [m.span() for m in _CANDIDATE.finditer(text, max(left, start), max(left, min(right, end)))]
    return found


def is_novel(text: str, start: int, end: int) -> bool:
    """Whether ``text[start:end]`` costs about as much as a random string."""
    run, cost = text[start:end], novelty(text, start, end, copies=False)
    if cost < MIN_NOVEL or cost < RANDOM_SHARE * random_cost(run):
        return False
    if any(c.isdigit() for c in run):
        return True
    if run.isupper():  # names of constants; ORDINARY is in lower case
        run = run.lower()
        text = text[:start] + run + text[end:]
    return novelty(text, start, end, ORDINARY, copies=False) >= ORDINARY_SHARE * random_cost(run, ORDINARY)


def novel_spans(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Candidates in a sensitive context that do not compress, outside ``taken`` spans."""
    low = text.lower()
    if not any(h in low for h in _SENSITIVE_HINTS):
        return []
    found, reached = [], 0
    for start, end in _candidates(text):
        if start < reached or any(start < e and s < end for s, e, _ in taken):
            continue
        if is_novel(text, start, end):
            found.append((start, end, "novel"))
            reached = end
    return found


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


RESULT = "struct<n_assign:long,n_access:long,n_hex:long,n_novel:long,base_sha256:string,spans:string>"


def _scan_one(text: str | None) -> tuple[int, int, int, int, str, str]:
    text = text or ""
    base = base_spans(text)
    novel = novel_spans(text, base)
    spans = sorted(base + novel, key=lambda s: (s[0], KINDS.index(s[2])))
    counts = [sum(kind == k for _, _, kind in spans) for k in KINDS]
    return (*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans))


def secrets_in(text: Column) -> Column:
    """Counts by kind, the digest of the patterns' spans, and all spans of a text."""

    @F.pandas_udf(RESULT)
    def scan_all(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(
            [_scan_one(t) for t in texts],
            columns=["n_assign", "n_access", "n_hex", "n_novel", "base_sha256", "spans"],
        )

    return scan_all(text)


def scan(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", secrets_in(F.col("text")).alias("found")).select("doc_id", "found.*")
