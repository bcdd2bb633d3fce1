"""Rows of the marketplace tables for tests."""

from datetime import date, datetime
from decimal import Decimal


def at(day: int, hour: int = 12, minute: int = 0, second: int = 0, micro: int = 0) -> datetime:
    """A moment in January 2024."""
    return datetime(2024, 1, day, hour, minute, second, micro)


def event(user, stay, kind="view", when=None, device="mobile", referrer="google"):
    return (user, stay, kind, when or at(10), (device, referrer))


def booking(id, user, stay, status="completed", amount="100.00", when=None, out=12):
    return (id, user, stay, status, Decimal(amount), when or at(10, 13), date(2024, 1, 11), date(2024, 1, out))


def payment(id, booked, status="completed", amount="100.00"):
    return (id, booked, status, "card", Decimal(amount))


def rows(frame, *columns):
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in chosen.collect()), key=lambda r: tuple(str(v) for v in r))
