"""The synchronisation run, its report, and the registered queries."""
