"""Import every query module so that each registers itself."""

from webledger.plans import q_cost  # noqa: F401
from webledger.plans import q_cache  # noqa: F401
from webledger.plans import q_pool  # noqa: F401
from webledger.plans import q_pages  # noqa: F401
from webledger.plans import q_search  # noqa: F401
from webledger.plans import q_monitor  # noqa: F401
from webledger.plans import q_stream  # noqa: F401
