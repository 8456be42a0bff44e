from panelweave.operators import encode, explain, joins, metrics, ordering, reshape, windows

__all__ = ["encode", "explain", "joins", "metrics", "ordering", "reshape", "windows"]
