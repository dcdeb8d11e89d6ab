"""The queries of the library: each module registers its own."""

from folio.plans import registry  # noqa: F401  isort: skip
from folio.plans import delivery, rich  # noqa: F401
