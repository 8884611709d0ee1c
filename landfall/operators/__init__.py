"""DataFrame operators: quality rules, protection, routing, audit, splitting."""
