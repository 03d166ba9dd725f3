from .testdata import read_driver_table  # noqa: F401
from .adapter import raw_model  # noqa: F401
