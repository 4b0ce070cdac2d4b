"""DataFrame operators: parsing, merging, URL lists, probing, reports, schedules, routing, features."""
