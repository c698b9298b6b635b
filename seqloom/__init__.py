"""Sequencing analytics as PySpark DataFrame operators."""

from .session import build_session

__all__ = ["build_session"]
