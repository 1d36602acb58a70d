"""Reading the untidy labels of trajectories: split names, task keys, sources."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPLITS = ("train", "validation", "test")
#: Spellings of the splits, after trimming and lower case.
SPELLINGS = {"train": ("train", "training", "trn"), "validation": ("validation", "valid", "val", "dev", "development", "eval"), "test": ("test", "testing", "tst")}
#: Values of a task key that stand for none, after trimming and lower case.
NO_KEY = ("", "-", "--", "?", "n/a", "na", "nan", "nil", "none", "null", "tbd", "todo", "undefined", "unknown", "unset")
_BLANK = "[\\s\\u00a0\\u200b\\ufeff]+"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, f"^{_BLANK}|{_BLANK}$", "")


def split_name(c: Column) -> Column:
    """train, validation or test; null if blank, null or none of them."""
    name = F.lower(trimmed(c))
    out = F.when(name.isin(*SPELLINGS["train"]), "train")
    for split in SPLITS[1:]:
        out = out.when(name.isin(*SPELLINGS[split]), split)
    return out


def source_name(c: Column) -> Column:
    """The name in lower case without blanks around it; null if that is empty."""
    name = F.lower(trimmed(c))
    return F.when(name != "", name)


def task_key(c: Column) -> Column:
    """owner/repository#number in lower case without leading zeros, read from
    any notation that names the three (owner__repo-1, owner/repo#1,
    owner/repo/1/, an address ending in owner/repo/issues/1); null if the value
    has no usable key.  A revision after ``@``, a query and a fragment that is
    no number are ignored."""
    key = F.lower(trimmed(c))
    key = F.regexp_replace(key, "[?].*$", "")
    key = F.regexp_replace(key, "@[^/#@]*$", "")
    key = F.regexp_replace(key, "/(issues?|pulls?|merge_requests|-)(?=[/#])", "")
    key = F.regexp_replace(key, "[/\\s]+$", "")
    part = "([a-z0-9][a-z0-9._-]*?)"
    pattern = f"(?:^|[/:@\\s]){part}(?:__|/){part}(?:#|/|-|:|!|__|\\s+#?)0*([0-9]+)$"
    hit = F.regexp_extract(key, pattern, 3)
    named = F.concat(F.regexp_extract(key, pattern, 1), F.lit("/"), F.regexp_extract(key, pattern, 2), F.lit("#"), hit)
    return F.when(key.isin(*NO_KEY), None).when(hit != "", named)
