"""What a cluster runs: ``spark-submit --py-files pairstats.zip submit.py 0.7 0.3 english in out``."""

from pairstats.__main__ import main

if __name__ == "__main__":
    main()
