"""A task as one object, and its run."""
