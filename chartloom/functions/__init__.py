from chartloom.functions import ids, jsonval, scores, text

__all__ = ["ids", "jsonval", "scores", "text"]
