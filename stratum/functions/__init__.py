"""Scalar helpers: exact integer arithmetic, text splitting, bit helpers."""

from stratum.functions.scalars import bit, cents, floor_div, int_div, is_block_repeat, nonempty_split

__all__ = ["bit", "cents", "floor_div", "int_div", "is_block_repeat", "nonempty_split"]
