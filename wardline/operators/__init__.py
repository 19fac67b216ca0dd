"""Jobs that join, group, window, train or write."""
