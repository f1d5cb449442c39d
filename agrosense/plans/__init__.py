"""Result plans: daily (Q1-Q5), hourly (Q7-Q11), batch suite (Q6), registered catalog."""
