from sparkdraft.functions import clean, keys, prob

__all__ = ["clean", "keys", "prob"]
