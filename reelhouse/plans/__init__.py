"""Role maps, rules, views and the registered queries."""
