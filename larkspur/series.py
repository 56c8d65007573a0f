"""A column's values as Arrow and numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

#: Days from 1970-01-01 to 2000-01-01, from which raw dates count.
EPOCH_DAYS = 10_957

_DTYPES = {"boolean": "bool", "tinyint": "i16", "smallint": "i16", "int": "i32", "bigint": "i64", "float": "f64", "double": "f64", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp", "string": "sym"}
_RAW = {"bool": np.uint8, "i16": np.int16, "i32": np.int32, "i64": np.int64, "f64": np.float64}


def dtype_of(kind: T.DataType) -> str:
    name = kind.simpleString()
    return _DTYPES.get(name, "time" if name.startswith("time(") else f"unknown({name})")


class Series:
    def __init__(self, name: str, kind: T.DataType, values: pa.Array):
        self.name, self.dtype, self._values = name, dtype_of(kind), values
        self._data: np.ndarray | None = None
        self._coded: pa.DictionaryArray | None = None

    def __len__(self) -> int:
        return len(self._values)

    @property
    def length(self) -> int:
        return len(self._values)

    @property
    def arrow(self) -> pa.Array:
        return self._values

    @property
    def data(self) -> np.ndarray:
        """Raw values; zero where null.  Dates are days since 2000-01-01,
        timestamps nanoseconds since 1970 (Spark keeps microseconds)."""
        if self._data is None:
            if self.dtype == "sym":
                raise TypeError("a sym column has indices and a dictionary, no data")
            if self.dtype == "date":
                raw = pc.subtract(self._values.cast(pa.int32()), EPOCH_DAYS)
            elif self.dtype == "timestamp":
                raw = pc.multiply(self._values.cast(pa.int64()), 1000)
            elif self.dtype in _RAW:
                raw = self._values
            else:
                raise TypeError(f"no raw values of type {self.dtype}")
            filled = pc.fill_null(raw, False if self.dtype == "bool" else 0)
            self._data = filled.to_numpy(zero_copy_only=False).astype(_RAW.get(self.dtype, np.int32 if self.dtype == "date" else np.int64), copy=False)
        return self._data

    @property
    def null_bitmap(self) -> np.ndarray | None:
        """One bit a row, least significant first, 1 for a value; none without
        nulls."""
        if not self._values.null_count:
            return None
        return np.packbits(self._values.is_valid().to_numpy(zero_copy_only=False), bitorder="little")

    def _codes(self) -> pa.DictionaryArray:
        if self.dtype != "sym":
            raise TypeError(f"a {self.dtype} column has no dictionary")
        if self._coded is None:
            self._coded = self._values.dictionary_encode()
        return self._coded

    @property
    def indices(self) -> np.ndarray:
        """Places in the dictionary, in 8, 16 or 32 bits as it needs; 0 where null."""
        coded = self._codes()
        n = len(coded.dictionary)
        width = np.uint8 if n <= 1 << 8 else np.uint16 if n <= 1 << 16 else np.uint32
        return pc.fill_null(coded.indices, 0).to_numpy(zero_copy_only=False).astype(width)

    @property
    def dictionary(self) -> list[str]:
        return self._codes().dictionary.to_pylist()

    def to_list(self) -> list:
        return self._values.to_pylist()
