"""Reading model outputs and publishing datasets."""
