"""Leaves of plain XML documents by regular expressions that are made from a schema.

Two replacements turn a document into its leaves: one every item of its list, one the rest of it.  The expressions take
what a parser needn't be asked about: known elements in any order, other elements up to ``DEPTH`` deep, white space between
them.  Each holds the whole text to its shape, end tags included.  All else (prefixes, references, comments, CDATA, empty
or untrimmed values, a repeated element with parts, deeper elements, broken text) gives no match and is left to the parser.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

VALUE = "_VALUE"
#: Levels of elements that the schema doesn't name.
DEPTH = 4
# none of these may stand in a document
_FIELD, _ITEM, _READ, _END = "\x01", "\x02", "\x03", "\x04"

_GAP = r"[ \t\r\n]*"
# single characters: ranges would make each test a chain of calls
_NOT = "<>&" + "".join(f"\\x{i:02X}" for i in (*range(0x20), *range(0x7F, 0xA0)))
#: A value that trimming doesn't change, and one within quotes.
_TEXT = f"([^{_NOT} ][^{_NOT}]*(?<! ))"
_QUOTED = f'"([^"{_NOT} ][^"{_NOT}]*(?<! ))"'
_NAME = "[A-Za-z][A-Za-z0-9]*"
_SPACES = (
    rf'(?: xmlns="[^"{_NOT}]*")?+(?: xmlns:xsi="[^"{_NOT}]*")?+(?: xsi:schemaLocation="[^"{_NOT}]*")?+' + _GAP
)
_DECLARED = r'(?:<\?xml version="1\.0"(?: encoding="(?i:UTF-8)")?+ ?\?>)?+'


class _Shape:
    """An expression as it is written: its groups so far, and the group of each leaf by path."""

    def __init__(self) -> None:
        self.groups = 0
        self.leaves: dict[str, int] = {}

    def group(self) -> int:
        self.groups += 1
        return self.groups

    def children(self, fields: list[StructField], path: str, but: tuple[str, ...] = ()) -> str:
        """Any number of elements: those of the fields, each that has parts at most once, and others, ``but`` not some."""
        ways, again = [], []
        for f in fields:
            way = self.child(f, f"{path}{f.name}")
            if isinstance(f.dataType, StructType):
                # groups keep what an earlier element of the name held, so there must be none
                way, mark = way + "()", self.group()
                again.append(rf"{f.name}[ >]\{mark}")
            ways.append(way)
        names = "|".join((*(f.name for f in fields), *but))
        ways.append(rf"(?!<(?i:{names})(?![\w-])){self.other(DEPTH)}")
        guard = f"(?!{_GAP}<(?:{'|'.join(again)}))" if again else ""
        return rf"(?:{_GAP}(?!</)(?:{'|'.join(ways)}){guard})*+{_GAP}"

    def child(self, f: StructField, path: str) -> str:
        kind = f.dataType
        if isinstance(kind, StringType):
            self.leaves[path] = self.group()
            return f"<{f.name}>{_TEXT}</{f.name}>"
        if VALUE in kind.names:
            quoted = "".join(rf"(?: {x[1:]}={_QUOTED})?+" for x in kind.names if x != VALUE)
            for x in (*(x for x in kind.names if x != VALUE), VALUE):
                self.leaves[f"{path}.{x}"] = self.group()
            return f"<{f.name}{quoted}>{_TEXT}</{f.name}>"
        return f"<{f.name}>{self.children(kind.fields, f'{path}.')}</{f.name}>"

    def other(self, depth: int) -> str:
        name = self.group()
        inner = rf"(?:{_GAP}{self.other(depth - 1)})++{_GAP}|" if depth > 1 else ""
        return rf"<({_NAME})(?: {_NAME}=\"[^\"{_NOT}]*\")?+>(?:{inner}[^{_NOT}]*)</\{name}>"


class Leaves:
    """The leaves of documents ``<any><root>...</root></any>`` with ``fields`` and, behind them, a list of items."""

    def __init__(self, fields: StructType, root: str):
        self.items = next(f for f in fields if isinstance(f.dataType, ArrayType))
        shape = _Shape()
        self._item = f"<{self.items.name}>{shape.children(self.items.dataType.elementType.fields, '')}</{self.items.name}>"
        text, self.of_item = self._order(shape)
        self._item_to = _ITEM + text + _END
        shape = _Shape()
        outer = shape.group()
        heads = shape.children([f for f in fields if f is not self.items], "", but=(self.items.name,))
        listed = shape.group()
        self._whole = (
            rf"\A{_DECLARED}{_GAP}<({_NAME}){_SPACES}>{_GAP}<{root}{_SPACES}>{heads}((?:{_ITEM}[^{_ITEM}{_END}<]*{_END}{_GAP})*+)"
            rf"</{root}>{_GAP}</\{outer}>{_GAP}\z"
        )
        self._whole_to, self.of_head = self._order(shape)
        self._whole_to = f"{_READ}{self._whole_to}${listed}"

    @staticmethod
    def _order(shape: _Shape) -> tuple[str, dict[str, int]]:
        """The replacement that sets the leaves in a row, and their places in it."""
        text = "".join(f"{_FIELD}${g}" for g in shape.leaves.values()) + _FIELD
        return text, {path: i + 1 for i, path in enumerate(shape.leaves)}

    def read(self, df: DataFrame, xml: str, out: str) -> DataFrame:
        """With a text that ``head`` and ``listed`` take apart, or null for a document that a parser has to read."""
        # groups outlive an item that doesn't match; the document goes to the parser then, as the item stays in it
        items = F.regexp_replace(xml, self._item, F.lit(self._item_to))
        flat = F.regexp_replace(items, self._whole, F.lit(self._whole_to))
        marked = F.col(xml).contains(_ITEM) | F.col(xml).startswith(_READ)
        # a one-element explode keeps the optimizer from repeating the replacements
        df = df.withColumn(out, F.explode(F.array(flat)))
        return df.withColumn(out, F.when(~marked & F.col(out).startswith(_READ), F.col(out)))

    @staticmethod
    def head(flat: str) -> Column:
        """The leaves outside the items, as an array."""
        return F.split(F.substring_index(flat, _ITEM, 1), _FIELD)

    @staticmethod
    def listed(flat: str) -> Column:
        """The items, as texts."""
        parts = F.split(flat, _ITEM)
        return F.slice(parts, 2, F.size(parts))

    @staticmethod
    def item(text: str) -> Column:
        """The leaves of an item, as an array."""
        return F.split(text, _FIELD)

    @staticmethod
    def leaf(fields: str, place: int) -> Column:
        value = F.get(fields, F.lit(place))
        return F.when(F.octet_length(value) > 0, value)
