"""Small formatting expressions: ISO timestamps and masked connection URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def iso_timestamp(ts) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]``; the fraction only when non-zero (``isoformat``)."""
    ts = _c(ts)
    frac = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(frac != "000000", F.concat(F.lit("."), frac)).otherwise(F.lit("")))


def mask_url(url) -> Column:
    """Hide the password of ``scheme://user:password@host``.

    The text before the first ``@`` must contain ``://`` and a ``:``; everything
    after its last ``:`` is replaced by ``***``. Other URLs pass unchanged.
    """
    url = _c(url)
    head = F.substring_index(url, "@", 1)
    rest = F.substr(url, F.length(head) + F.lit(2))
    masked = F.concat(F.regexp_replace(head, ":[^:]*$", ""), F.lit(":***@"), rest)
    eligible = url.contains("@") & head.contains("://") & head.contains(":")
    return F.when(eligible, masked).otherwise(url)
