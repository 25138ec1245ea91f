"""User-level plan shapes that keep work distributed: blocked prefix scans, sliding-window panes
and time-bucketed range joins. No Catalyst rules are involved: each is a composition of DataFrame operators that Catalyst plans as usual."""

from .guards import materialize
from .panes import sliding_aggregate
from .prefix import running

__all__ = ["materialize", "running", "sliding_aggregate"]
