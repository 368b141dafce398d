"""Protected columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playmart.operators.tables import update_only


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: bytes, iv: bytes) -> DataFrame:
    """AES-CBC text in base64 as plain text; null stays null, and what cannot be decrypted stays as it is."""

    def plain(c: str):
        raw = F.concat(F.lit(iv), F.try_to_binary(F.col(c), F.lit("base64")))
        return F.coalesce(F.try_aes_decrypt(raw, F.lit(key), F.lit("CBC"), F.lit("PKCS")).cast("string"), F.col(c))

    return df.withColumns({c: plain(c) for c in columns})


def suspect_report(users: DataFrame, ids: DataFrame, columns: Sequence[str], protected: Sequence[str], key: bytes, iv: bytes) -> DataFrame:
    """The columns of a list of users, protected ones decrypted for these only."""
    mine = users.join(ids, "id", "left_semi").select("id", *columns)
    return decrypt_columns(mine, protected, key, iv)


def protect_backfill(users: DataFrame, stage: DataFrame, renamed: Mapping[str, str]) -> DataFrame:
    """Stage columns, some under their protected names, updated into the users; nothing is inserted."""
    new = stage.withColumnsRenamed(dict(renamed))
    return update_only(users, new, ["id"], [c for c in new.columns if c != "id"])
