"""DataFrame operators: change (insert / update / delete), audit, frame helpers."""
