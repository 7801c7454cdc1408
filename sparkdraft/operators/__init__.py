from sparkdraft.operators import checks, joins, merge, ordering, reshape

__all__ = ["checks", "joins", "merge", "ordering", "reshape"]
