"""The package on the executors; the library's own helper, under the name used here."""

from __future__ import annotations

from haulback.shipping import ship_package

__all__ = ["ship_package"]
