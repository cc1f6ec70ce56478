"""Multi-step plans: the daily load and the hand-over of small results."""
