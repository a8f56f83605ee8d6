"""The catalogue of contact layouts and the fixed phrases that locate a contact list."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import cache
from importlib.resources import files

# Unicode classes, any case, only '\n' ends a line.
FLAGS = "(?diU)"
CASED = "(?dU)"

# Stored contact columns, and the columns of the merged file.
CONTACT_COLUMNS = [
    "fdd_name", "phone", "email", "owner_name", "website", "state", "city", "address", "zipcode",
    "additional_information", "franchise_id", "franchise_name", "title", "method", "regex",
]
MERGED_COLUMNS = [
    "#", "fdd_name", "owner_name", "email", "phone", "website", "state", "city", "address", "zipcode",
    "additional_information", "franchise_id", "franchise_name", "title", "company_name", "linkedin_profile",
]

# Texts that rule a page out, and page classes.
NOT_A_CONTACT_PAGE = r"state\s+administrator|item\s+19|\$|direct\s+franchise\s+agreement"
NOT_A_LIST_PAGE = r"state\s+administrator|item\s+19|\$|(purchase|franchise)\s+agreement|business\s+experience"
TOTALS_PAGE = r"total|provision"
MIN_TEXT = 100

# Header of an extracted table -> contact column, first match wins.
HEADER_RULES = [
    (r"fdd_name", "fdd_name"),
    (r"method", "method"),
    (r"regex", "regex"),
    (r"^(?!franchise|business|fdd|location|entity|territory|office|company|legal|branch|address)"
     r"\n {28}name|owner|proprietor|first|last|personnel|contact", "owner_name"),
    (r".*email.*|e-mail|e mail", "email"),
    (r".*phone.*|tel|.*number.*", "phone"),
    (r".*website.*", "website"),
    (r"^(?!city|store).*state.*|^(?!city|store|start)st", "state"),
    (r".*city.*", "city"),
    (r".*address.*|.*street.*", "address"),
    (r".*zip.*|postal", "zipcode"),
    (r".*additional information.*|.*other.*|.*note.*|.*#.*|rest\. no\.|franchise id|id", "additional_information"),
    (r"^(?!number).*franchise.*|.*business.*|.*entity.*|.*company.*|.*legal.*|licensee|office", "company_name"),
    (r".*title.*|location", ""),
]
# The owner rule above never sees a plain "Name", for it asks for a line break and blanks before it. Without them:
EXACT_HEADER_RULES = {"owner_name": r"^(?!franchise|business|fdd|location|entity|territory|office|company|legal|branch|address)name|owner|proprietor|first|last|personnel|contact"}

# Columns a header can lead to, those that join repeated columns, number of target columns.
TABLE_COLUMNS = ["fdd_name", "method", "regex", "owner_name", "email", "phone", "website", "state", "city", "address", "zipcode",
                 "additional_information", "company_name"]
JOINED_COLUMNS = ["owner_name", "email", "address"]
TARGETS = 17

# How the exhibit that holds the list is named.
EXHIBIT_NAME = r'(?:exhibits?|attachments?|appendi(?:x|ces)?)\s+((?:\[?"?)\w+(?:"?]?))'
EARN_PAGE = r"how\s+much\s+(?:can|will)\s+i\s+earn"
EARN_END = r"how\s+much\s+w(?!.+earn)"
LIKE_START = r"what(?:’s|'s|\s+is)\s+it\s+like\s+to\s+be"
LIKE_END = r"what\s+else\s+should\s+i\s+know"
HOW_TO_PAGE = r"(How\s+to\s+Use\s+This\s+Franchise\s+Disclosure\s+Document)|(What\s+You\s+Need\s+To\s+Know)"
CONTENTS_PAGE = r"table\s+of\s+contents(?!\s+of\s+operations\s+manual)"
SIMPLIFY_PAGE = r"to\s+simplify|for\s+ease\s+of\s+reference"
LAST_SEARCH_PAGE = 20
ITEM_20 = (
    r"the\s+following\s+(?:is|are|tables).+(?:address|franchise).+(?:\d{4}|year|system):"
    r"|current\s+outlet\s+information|contact\s+information\s+for\s+franchisees"
    r"|franchisee\s+locations\s+as\s+of.+(?:\d{4}|year)"
)
EXHIBIT_IN_CONTENTS = [
    r'(?:exhibit|attachment|appendix)\s+((?:\[?"?)\w+(?:"?]?)).*(?:franchisees|franchised|franchise\s+directory)',
    r'(?:exhibit|attachment|appendix)\s+((?:\[?"?)\w+(?:"?]?))\s+.*\s*.*(?:franchisees|franchised|franchise\s+directory)(?!\s+territory)',
    r'(?:exhibits?|attachments?|appendi(?:x|ces)?)\s+((?:\[?"?)\w+(?:"?]?))\.?\s+(?:list\s+of).*(?:franchisees|franchised)',
    r'(?:exhibits?|attachments?|appendi(?:x|ces)?)\s+.*\s+((?:\[?"?)\w+(?:"?]?))\.?.*(?:franchisees|franchised|franchise\s+directory)',
    r'((?:\[?"?)\w+(?:"?]?))\.?:?-?\d?\s+(?:list\s+of).*(?:franchisees|franchised|franchise\s+owners|franchise\s+operators|outlets)',
    r'^(?!item|obligation)((?:\[?"?)\w+(?:"?]?)).*(?:franchisees|franchised|franchise\s+directory)',
    r'((?:\[?"?)\w+(?:"?]?))\.?:?-?\d?\s+(?:list\s+of) (?!state|agent)',
]


@dataclass(frozen=True)
class Layout:
    """One contact layout. ``groups`` gives the group numbers of a field; their texts are joined."""

    ord: int
    name: str
    regex: str
    fields: tuple[tuple[str, tuple[int, ...]], ...]
    tail: str
    needs: tuple[str, ...]
    has_email: bool


def _groups(pattern: str):
    """(position, depth, name or None) of each capturing group, left to right."""
    depth, i, in_class = 0, 0, False
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\":
            i += 2
            continue
        if in_class:
            in_class = ch != "]"
        elif ch == "[":
            in_class = True
            if pattern[i + 1] == "]":
                i += 1
        elif ch == "(":
            named = re.match(r"\(\?P<(\w+)>", pattern[i:])
            if named or pattern[i + 1] != "?":
                yield i, depth, named.group(1) if named else None
            depth += 1
        elif ch == ")":
            depth -= 1
        i += 1


def java(pattern: str) -> str:
    """Named groups become plain ones: Java group names may not hold an underscore."""
    return re.sub(r"\(\?P<\w+>", "(", pattern)


def layout(ord: int, name: str, pattern: str) -> Layout:
    fields: dict[str, tuple[int, ...]] = {}
    cuts = []
    for number, (pos, depth, field) in enumerate(_groups(pattern), start=1):
        if field is None:
            continue
        fields[field] = fields.get(field, ()) + (number,)
        if depth == 0 and field in ("state", "zip", "zipcode", "phone"):
            cuts.append(pos)
    phone = pattern.find("(?P<phone>")
    return Layout(ord, name, FLAGS + java(pattern), tuple(fields.items()),
                  FLAGS + java(pattern[phone:] if phone >= 0 else pattern),
                  # A match of the whole implies a match of each of its ends: cheap, exact tests, shortest first.
                  tuple(FLAGS + java(pattern[cut:]) for cut in reversed(cuts) if cut > 0),
                  "email" in pattern)


@cache
def catalogue() -> tuple[Layout, ...]:
    # Executors import this package from an archive, where a file has no path of its own.
    lines = files(__package__).joinpath("contact_patterns.txt").read_text(encoding="utf-8").splitlines()
    entries = [line.split("\t", 1) for line in lines if not line.startswith("#")]
    return tuple(layout(i, name, pattern) for i, (name, pattern) in enumerate(entries))
