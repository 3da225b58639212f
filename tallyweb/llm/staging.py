"""Tables written once and read again."""

from ..sources.staged import shared_dir, staged

__all__ = ["shared_dir", "staged"]
