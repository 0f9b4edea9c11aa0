"""Wikitext to words: one scan, the first kind that matches wins, words and CJK words stay.

The scan is a regular expression of the JVM.  White space and breaks need no kind of their own, as what fits no
kind is passed over; reference marks are tags.  Classes are ASCII but for the scripts listed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Protocols of links, without and with slashes (patterns, as they stand).
PLAIN = ("bitcoin", "geo", "magnet", "mailto", "news", "sips?", "tel", "urn")
SLASHED = ("https?", "ftp", "ftps", "git", "gophe", "ircs?", "mms", "nntp", "redis", "sftp", "ssh", "svn", "telnet", "worldwind", "xmpp")
#: Ranges of code points written without spaces (Chinese, Japanese, Korean).
CHINESE = (
    (0x4E00, 0x62FF), (0x3400, 0x4DFF), (0x20000, 0x215FF), (0xF900, 0xFAFF), (0x2F800, 0x2FA1F), (0x6300, 0x77FF),
    (0x7800, 0x8CFF), (0x8D00, 0x9FCC), (0x21600, 0x230FF), (0x23100, 0x245FF), (0x24600, 0x260FF), (0x26100, 0x275FF),
    (0x27600, 0x290FF), (0x29100, 0x2A6DF), (0x4E00, 0x9FCB), (0xF900, 0xFA6A), (0x3220, 0x3243), (0x3280, 0x337F),
)
JAPANESE = ((0x3041, 0x3096), (0x30A0, 0x30FF), (0x3400, 0x4DB5), (0x2E80, 0x2FD5), (0xFF5F, 0xFF9F), (0x31F0, 0x31FF))
KOREAN = ((0xAC00, 0xD7AF), (0x1100, 0x11FF), (0x3130, 0x318F), (0xA960, 0xA97F), (0xD7B0, 0xD7FF))
#: Ranges of code points that make words beside ASCII letters (Devanagari, Arabic, Bengali, Cyrillic).
DEVANAGARI = ((0x0901, 0x0963),)
ARABIC = ((0x0601, 0x061A), (0x061C, 0x0669), (0x06D5, 0x06EF))
BENGALI = ((0x0980, 0x09FF),)
CYRILLIC = ((0x0400, 0x04FF), (0x0500, 0x052F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F), (0x1C80, 0x1C8F), (0x1D2B, 0x1D78), (0xFE2E, 0xFE2F))


def _class(*ranges: tuple[int, int]) -> str:
    return "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges)


def scan_pattern(java: bool = True) -> str:
    """The scan, with words as its first group, in Java's dialect or RE2's.

    A word boundary is between an ASCII word character and another one; Java's own is not, so it is spelled out.
    """
    here, after_word, end = ("(?<![0-9A-Za-z_])", "(?<=[0-9A-Za-z_])", "(?![0-9A-Za-z_])") if java else (r"\b", r"\b", r"\b")
    blank, word, cjk = r"\t\n\f\r ", "0-9A-Za-z_" + _class(*DEVANAGARI, *ARABIC, *BENGALI, *CYRILLIC), _class(*CHINESE, *JAPANESE, *KOREAN)
    kinds = [
        rf"</?[a-z][a-z0-9]*{end}[^>]*>",
        r"[\x{3000}-\x{303F}]",
        rf"(?:{here}[0-9]+(?:[,.][0-9]+)*(?:e[0-9]+)*|{after_word}(?:[.,][0-9]+)+(?:e[0-9]+)*){end}",
        rf"(?:(?:{'|'.join(PLAIN)}):|(?:(?:{'|'.join(SLASHED)}):)?//)[^{blank}/$.?#][^|<>{blank}{{}}]*",
        rf"([{word}]+(?:['’][{word}]+)*|[{cjk}]*(?:['’][{cjk}]+)*)",
    ]
    return "|".join(kinds)


def tokens(text: Column) -> Column:
    """Words of a text in order; none of a null one."""
    found = F.regexp_extract_all(F.replace(F.coalesce(text, F.lit("")), F.lit("\\n"), F.lit(" ")), F.lit(scan_pattern()), F.lit(1))
    return F.filter(found, lambda w: w != "")
